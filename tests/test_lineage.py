from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.constants import PATH_ARROW
from tidemark.operators import lineage
from tidemark.operators.joins import spread_join
from tidemark.plans.retail import MODELS
from tidemark.plans.run import ARTIFACT_SCHEMA, model_edges, refresh_lineage
from tidemark.session import local_rows

EVENT = "event_id string, table_name string, column_name string, change_type string, old_data_type string, new_data_type string"


def edge(source, target):
    return (target.lower(), "dbt_model", source, None, f"sql of {target}", f"models/{target}.sql", f"DB.{target}")


def edges(spark, pairs):
    return local_rows(spark, [edge(*p) for p in pairs], ARTIFACT_SCHEMA)


def events(spark, rows):
    return local_rows(spark, rows, EVENT)


def all_paths(pairs, start, limit=50):
    """Every simple path below a table, by brute force."""
    out = []

    def go(node, path):
        for a, b in pairs:
            if a == node and f"DB.{b}" not in path and b != start:
                out.append((b, [*path, f"DB.{b}"]))
                go(b, [*path, f"DB.{b}"])

    go(start, [start])
    return out


def expected(pairs, start):
    best = {}
    for node, path in all_paths(pairs, start):
        depth, text = len(path) - 1, PATH_ARROW.join(path)
        old = best.get(node, (depth, text, depth))
        best[node] = (min(depth, old[0]), min(text, old[1]), max(depth, old[2]))
    return best


def test_retail_impact(spark):
    got = lineage.impact(
        events(spark, [("e1", "ORDERS", "CHANNEL", "COLUMN_DROP", "string", None)]), model_edges(spark, MODELS, "SHOP"), "SHOP"
    )
    assert {(r.artifact_name, r.depth, r.impact_path, r.is_breaking) for r in got.collect()} == {
        ("silver.orders", 1, "BRONZE.ORDERS → SHOP.SILVER.ORDERS", True),
        ("gold.orders_daily", 2, "BRONZE.ORDERS → SHOP.SILVER.ORDERS → SHOP.GOLD.ORDERS_DAILY", True),
    }


@pytest.mark.parametrize("seed", range(4))
def test_random_graphs(spark, seed):
    """Smallest depth and smallest path independently, largest depth for the run order, in graphs with diamonds."""
    rng = random.Random(seed)
    names = [f"S.{n}" for n in ("B", "B1", "A", "C", "AA", "D", "E2")]
    pairs = [("BRONZE.T", n) for n in rng.sample(names[:3], 2)]
    pairs += [(a, b) for i, a in enumerate(names) for b in names[i + 1:] if rng.random() < 0.45]
    pairs = sorted(set(pairs))
    want = expected(pairs, "BRONZE.T")
    got = lineage.impact(events(spark, [("e", "T", "C", "NEW_COLUMN", None, "int")]), edges(spark, pairs), "DB")
    assert {r.output_fqn[3:]: (r.depth, r.impact_path) for r in got.collect()} == {k: v[:2] for k, v in want.items()}
    origin = local_rows(spark, [("BRONZE.T",)], "origin string")
    order = lineage.downstream(origin, edges(spark, pairs), "DB")
    assert {r.output_fqn[3:]: r.run_order for r in order.collect()} == {k: v[2] for k, v in want.items()}


def test_cycles_end_and_chains_have_no_limit(spark):
    loop = [("BRONZE.T", "S.A"), ("S.A", "S.B"), ("S.B", "S.C"), ("S.C", "S.A")]
    got = lineage.impact(events(spark, [("e", "T", "C", "TYPE_CHANGE", "a", "b")]), edges(spark, loop), "DB")
    assert {(r.output_fqn, r.depth) for r in got.collect()} == {("DB.S.A", 1), ("DB.S.B", 2), ("DB.S.C", 3)}
    back = [("BRONZE.T", "S.A"), ("S.A", "BRONZE.T")]
    got = lineage.impact(events(spark, [("e", "T", "C", "TYPE_CHANGE", "a", "b")]), edges(spark, back), "DB")
    assert {(r.output_fqn, r.depth) for r in got.collect()} == {("DB.S.A", 1)}, "the start is not below itself"
    nothing = lineage.impact(events(spark, [("e", "X", "C", "TYPE_CHANGE", "a", "b")]), edges(spark, loop), "DB")
    assert nothing.count() == 0
    origin = local_rows(spark, [("BRONZE.T",)], "origin string")
    with pytest.raises(ValueError):
        lineage.downstream(origin, edges(spark, loop), "DB")


def test_a_chain_of_150_levels(spark):
    length = 150
    chain = [("BRONZE.T", "S.N0")] + [(f"S.N{i}", f"S.N{i + 1}") for i in range(length - 1)]
    order = lineage.downstream(local_rows(spark, [("BRONZE.T",)], "origin string"), edges(spark, chain), "DB")
    assert {r.artifact_name: r.run_order for r in order.collect()} == {f"s.n{i}": i + 1 for i in range(length)}
    links = local_rows(spark, [(str(i), str(i + 1)) for i in range(40)], "src string, dst string")
    steps = lineage.reach(local_rows(spark, [("0",)], "node string"), links)
    assert {int(r.node): r.depth for r in steps.collect()} == {i: i for i in range(41)}


def least_steps(pairs, starts):
    steps, front = {n: 0 for n in starts}, list(starts)
    while front:
        front = sorted({b for a, b in pairs if a in front and b not in steps})
        steps |= {n: 1 + max(steps.values()) for n in front}
    return steps


def tree(rng, size):
    return [(f"n{rng.randrange(max(0, i - 4), i)}", f"n{i}") for i in range(1, size)]


def grid(side):
    right = [(f"{x},{y}", f"{x + 1},{y}") for x in range(side - 1) for y in range(side)]
    return right + [(a[::-1], b[::-1]) for a, b in right]


GRAPHS = {
    "tree": (tree(random.Random(1), 60), ["n0", "n7"]),
    "grid": (grid(5), ["0,0"]),
    "cycles": ([("a", "b"), ("b", "c"), ("c", "d"), ("d", "b"), ("x", "y"), ("y", "x"), ("y", "z"), ("d", "e"), ("e", "e"), (None, "q"), ("e", None)], ["a"]),
    "start in a cycle": ([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("c", "d")], ["b", "b"]),
    "long way round": ([(f"l{i}", f"l{i + 1}") for i in range(20)] + [("l0", "l18"), ("s", "l5"), ("l20", "t")], ["l0", "s"]),
    "none": ([], ["a"]),
}


@pytest.mark.parametrize("name, plain", [*[(name, 0) for name in GRAPHS], ("long way round", 2)])
def test_reach_beyond_the_plain_levels(spark, monkeypatch, name, plain):
    monkeypatch.setattr(lineage, "PLAIN_LEVELS", plain)
    pairs, starts = GRAPHS[name]
    links = local_rows(spark, pairs, "src string, dst string")
    got = lineage.reach(local_rows(spark, [(s,) for s in starts], "node string"), links).collect()
    known = [p for p in pairs if None not in p]
    assert sorted((r.node, r.depth) for r in got if r.node) == sorted(least_steps(known, dict.fromkeys(starts)).items())


def test_a_chain_of_5000_hops(spark):
    hops = 5000
    links = local_rows(spark, [(f"{i}", f"{i + 1}") for i in range(hops)], "src string, dst string")
    got = lineage.reach(local_rows(spark, [("0",)], "node string"), links)
    assert {int(r.node): r.depth for r in got.collect()} == {i: i for i in range(hops + 1)}


def test_run_order_beyond_the_plain_levels(spark, monkeypatch):
    """The longest way, where several ways join, a table is an origin and below another one, and two artifacts write one table."""
    monkeypatch.setattr(lineage, "PLAIN_LEVELS", 1)
    rng = random.Random(3)
    names = [f"S.N{i}" for i in range(12)]
    pairs = sorted({("BRONZE.T", names[0]), ("BRONZE.T", names[3])} | {(a, b) for i, a in enumerate(names) for b in names[i + 1:] if rng.random() < 0.3})
    rows = [edge(*p) for p in pairs] + [("twin", "dbt_model", "BRONZE.T", None, "", "f", f"DB.{names[6]}")]
    origins = local_rows(spark, [("BRONZE.T",), (names[1],)], "origin string")
    got = lineage.downstream(origins, local_rows(spark, rows, ARTIFACT_SCHEMA), "DB")

    longest = {"BRONZE.T": 0, names[1]: 0}
    for n in names:
        ways = [longest[r[2]] + 1 for r in rows if r[6] == f"DB.{n}" and r[2] in longest]
        if ways:
            longest[n] = max(ways + [longest.get(n, 0)])
    want = {}
    for r in rows:
        if r[2] in longest:
            want[r[0], r[6]] = max(want.get((r[0], r[6]), 0), longest[r[2]] + 1)
    assert {(r.artifact_name, r.output_fqn): r.run_order for r in got.collect()} == want
    loop = [("BRONZE.T", "S.A"), ("S.A", "S.B"), ("S.B", "S.C"), ("S.C", "S.A")]
    for more in (loop, [("BRONZE.T", "S.A"), ("S.A", "S.A")], [("BRONZE.T", "S.A"), ("S.A", "BRONZE.T")]):
        with pytest.raises(ValueError):
            lineage.downstream(local_rows(spark, [("BRONZE.T",)], "origin string"), edges(spark, more), "DB").collect()


def test_reach_with_cycle(spark):
    links = local_rows(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("x", "y")], "src string, dst string")
    start = local_rows(spark, [("a",)], "node string")
    assert {tuple(r) for r in lineage.reach(start, links).collect()} == {("a", 0), ("b", 1), ("c", 1)}


def test_by_column(spark):
    rows = [("all", "dbt_model", "BRONZE.T", None, "", "", "DB.S.ALL"), ("one", "dbt_model", "BRONZE.T", ["A"], "", "", "DB.S.ONE"),
            ("other", "dbt_model", "BRONZE.T", ["B"], "", "", "DB.S.OTHER")]
    got = lineage.impact_by_column(
        events(spark, [("e", "T", "A", "COLUMN_DROP", None, None)]), local_rows(spark, rows, ARTIFACT_SCHEMA)
    )
    assert {r.artifact_name for r in got.collect()} == {"all", "one"}


def test_reports(spark):
    rows = [
        ("drop", "T", "C", "COLUMN_DROP", "int", None),
        ("lonely", "Z", "C", "NEW_COLUMN", None, "int"),
        ("odd", "T", "C", "RENAME", None, None),
        ("new", "W", None, "NEW_TABLE", None, None),
    ]
    pairs = [("BRONZE.T", f"S.A{i:02d}") for i in range(25)] + [("S.A03", "G.B")]
    queue = events(spark, rows)
    impacted = lineage.impact(queue, edges(spark, pairs), "DB")
    specs = local_rows(spark, [("BRONZE", "W", "models/silver/w.sql", "W_ID", 1, "W_ID", "int")],
                       "table_schema string, table_name string, silver_model_path string, primary_key string, "
                       "ordinal_position int, column_name string, data_type string")
    got = lineage.impact_report(queue, impacted, specs).collect()
    head = {r.event_id: json.loads(r.report) for r in got if r.part == "event"}
    assert len(head) == len(rows) and all(r.place == 0 for r in got if r.part == "event")
    assert head["drop"] == {"event": {
        "event_id": "drop", "table_name": "T", "column_name": "C", "change_type": "COLUMN_DROP", "old_type": "int",
        "new_type": "", "is_breaking": True,
    }}
    listed = sorted((r.place, r.name) for r in got if r.event_id == "drop" and r.part == "impacted")
    assert len(listed) == 26 and listed[-1] == (2, "g.b")
    last = next(json.loads(r.report) for r in got if r.name == "g.b")
    assert last["impact_path"] == "BRONZE.T → DB.S.A03 → DB.G.B" and last["depth"] == 2
    assert [r.part for r in got if r.event_id == "lonely"] == ["event"]
    assert head["odd"] == {"error": "Unknown change_type: RENAME"}
    assert head["new"]["generate"] == {
        "action": "CREATE", "silver_model_path": "models/silver/w.sql", "sources_yml_path": "models/sources.yml",
        "primary_key": "W_ID",
    }
    assert [json.loads(r.report) for r in got if r.part == "column"] == [{"name": "W_ID", "type": "int"}]
    for without in (None, specs.limit(0)):
        bare = {r.event_id: json.loads(r.report) for r in lineage.impact_report(queue, impacted, without).collect() if r.part == "event"}
        assert bare.keys() == head.keys() and bare["new"]["generate"]["primary_key"] is None


def test_2500_artifacts_keep_their_order(spark):
    pairs = [("BRONZE.T", f"S.A{i:05d}") for i in range(2500)]
    queue = events(spark, [("e", "T", "C", "COLUMN_DROP", "int", None)])
    report = lineage.impact_report(queue, lineage.impact(queue, edges(spark, pairs), "DB"))
    names = [r.name for r in report.filter("part = 'impacted'").orderBy("event_id", "part", "place", "name").collect()]
    assert names == [f"s.a{i:05d}" for i in range(2500)]


def test_manifest_and_registry(spark):
    lines = [
        '  {"unique_id": "model.p.a", "name": "a", "config": {"schema": "silver"}, "original_file_path": "m/a.sql",'
        ' "depends_on": {"nodes": ["source.p.bronze.t", "macro.p.x", "model.p.gone"]}, "extra": 1}',
        '{"unique_id": "model.p.b", "name": "b", "config": {"schema": "Gold"}, "original_file_path": "m/b.sql",'
        ' "depends_on": {"nodes": ["model.p.a", "model.p.a2"]}}',
        "Running with 3 threads", '{"unique_id": "model.p.c", ', '{"name": "no id"}', "",
    ]
    lines += ["\t" + lines[0].strip().replace("m/a.sql", "m/a2.sql"), lines[1] + "] [", lines[1].replace('"b"', '"bb"') + "}, {}",
              lines[0].strip().replace('"extra": 1', '"raw_code": "SELECT 1", "more": [{"x": [1]}]')]
    placed = local_rows(spark, list(enumerate(lines)), "place int, line string")
    models = lineage.parse_manifest(placed, place="place")
    got = lineage.edges_from_models(models, "DB")
    texts = {r.artifact_name: r.artifact_sql for r in got.collect()}
    assert texts == {"silver.a": "SELECT 1", "gold.b": ""}
    registry = local_rows(spark, [("x", "copy_into", "S", None, "", "", None)], ARTIFACT_SCHEMA)
    assert refresh_lineage(registry, got, production=True).count() == 3
    assert {(r.artifact_name, r.source_table, r.output_fqn, r.file_path) for r in got.collect()} == {
        ("silver.a", "BRONZE.T", "DB.SILVER.A", "m/a.sql"), ("gold.b", "SILVER.A", "DB.GOLD.B", "m/b.sql"),
    }
    held = local_rows(spark, [("x", "copy_into", "S", None, "", "", None), ("y", "dbt_model", "S", None, "", "", "f")], ARTIFACT_SCHEMA)
    new = model_edges(spark, MODELS, "SHOP")
    assert {r.artifact_name for r in refresh_lineage(held, new, production=True).collect()} == {"x", *MODELS}
    assert refresh_lineage(held, new, production=False).count() == 2
    assert refresh_lineage(held, new.limit(0), production=True).count() == 2


def test_code_lookup_takes_one_text(spark):
    impacted = local_rows(spark, [("e", "a"), ("f", "a"), ("e", "none")], "event_id string, artifact_name string")
    texts = edges(spark, [("X", "A"), ("Y", "A")])
    got = [tuple(r) for r in lineage.with_current_sql(impacted, texts).collect()]
    assert sorted(got) == [("a", "sql of A"), ("none", "")]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_is_a_join(spark, how):
    left = spark.range(300).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS v")
    right = spark.range(0, 200, 2).selectExpr("id AS k", "id * 10 AS w")
    want = sorted(left.join(right, ["k"], how).collect())
    assert sorted(spread_join(left, right, ["k"], how, ["v"], spread=5).collect()) == want
