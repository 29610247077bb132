"""Lineage: dependency edges, what a change reaches, and the report on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import COLUMN_CHANGES, MODEL_ARTIFACT, NEW_TABLE, PATH_ARROW
from ..functions.columns import ends_with_value, is_breaking, json_items, name_part, strip, without_database
from ..session import cut

MANIFEST_SCHEMA = (
    "struct<unique_id: string, name: string, config: struct<schema: string>, original_file_path: string, "
    "raw_code: string, depends_on: struct<nodes: array<string>>>"
)
ARTIFACT = ["artifact_name", "artifact_type", "file_path", "output_fqn"]


def parse_manifest(lines: DataFrame, column: str = "line", place: str | None = None) -> DataFrame:
    """Model rows from JSON lines; other lines and lines that do not parse are left out. Of lines with one id the
    last by `place` counts, or the largest if the lines have no place."""
    text = strip(F.col(column))
    at = F.col(place) if place else F.lit(0)
    told = lines.select(at.alias("_at"), text.alias("_text")).filter(F.col("_text").startswith("{"))
    # Only a text that closes an object and then an array can hold more than the one value that is parsed.
    whole = F.when(F.regexp_like("_text", F.lit(r"\}\s*\]")), ends_with_value(F.col("_text"))).otherwise(True)
    items = told.filter(whole).select("_at", json_items(F.col("_text"), MANIFEST_SCHEMA).alias("_items"))
    # `inline` keeps the parsed row as one step; plain field references would parse once each.
    parsed = items.select("_at", F.inline(F.when(F.size("_items") == 1, F.col("_items"))))
    models = parsed.filter(
        F.col("unique_id").isNotNull() & F.col("name").isNotNull() & F.col("config.schema").isNotNull()
        & F.col("depends_on.nodes").isNotNull()
    ).select(
        "_at", "unique_id", "name", F.upper("config.schema").alias("schema"),
        F.col("original_file_path").alias("file_path"), F.coalesce("raw_code", F.lit("")).alias("artifact_sql"),
        F.col("depends_on.nodes").alias("depends_on"),
    )
    own = F.struct("_at", "name", "schema", "file_path", "artifact_sql", "depends_on")
    return models.groupBy("unique_id").agg(F.max(own).alias("m")).select("unique_id", "m.*").drop("_at")


def edges_from_models(models: DataFrame, database: str) -> DataFrame:
    """One edge per dependency, as the artifact registry holds it: a declared source, or another model looked up by
    its id. Dependencies on unknown models or on anything else give no edge."""
    dep = F.col("dep")
    output = F.concat_ws(".", F.lit(database), F.col("schema"), F.upper("name"))
    text = F.col("artifact_sql") if "artifact_sql" in models.columns else F.lit("")
    deps = models.select(
        F.concat(F.lower("schema"), F.lit("."), F.col("name")).alias("artifact_name"),
        F.lit(MODEL_ARTIFACT).alias("artifact_type"),
        "file_path",
        output.alias("output_fqn"),
        text.alias("artifact_sql"),
        F.explode("depends_on").alias("dep"),
    )
    named = F.concat_ws(".", F.upper(name_part(dep, 3)), F.upper(name_part(dep, 4)))
    from_sources = deps.filter(dep.startswith("source.")).withColumn("source_table", named).drop("dep")
    targets = models.select(
        F.col("unique_id").alias("dep"), F.concat_ws(".", F.col("schema"), F.upper("name")).alias("source_table")
    )
    from_models = deps.filter(dep.startswith("model.")).join(targets, "dep").drop("dep")
    return from_sources.unionByName(from_models).select(
        "artifact_name", "artifact_type", "source_table", F.lit(None).cast("array<string>").alias("source_columns"),
        "artifact_sql", "file_path", "output_fqn",
    )


def walk(starts: DataFrame, edges: DataFrame, database: str) -> DataFrame:
    """Everything downstream of `starts` (one column, `origin`: a table name).

    One join per level; each level keeps one row per origin and artifact with its smallest path, which
    is enough for the smallest path overall and keeps diamonds from multiplying. A path never visits
    a table twice, so cycles end. Returns rows per origin and artifact among which are its least depth and its least path.
    """
    steps = edges.select(*ARTIFACT, "source_table")
    frontier = starts.select("origin", F.col("origin").alias("node"), F.col("origin").alias("path")).distinct()
    levels: list[DataFrame] = []
    arrow = F.lit(PATH_ARROW)
    output = without_database(F.col("output_fqn"), database)
    while True:
        onward = F.concat(F.col("path"), arrow, F.col("output_fqn"))
        # The start has no database before its name, so names are compared without it.
        behind = F.concat(arrow, without_database(F.col("path"), database), arrow)
        reached = (
            frontier.join(steps, F.col("node") == F.col("source_table"))
            .filter(~behind.contains(F.concat(arrow, output, arrow)))
            .groupBy("origin", *ARTIFACT)
            .agg(F.min(onward).alias("path"))
        )
        level = cut(reached.withColumn("depth", F.lit(len(levels) + 1)), "walk")
        if level.isEmpty():
            return _all_levels(levels, level)
        levels.append(level)
        frontier = level.select("origin", output.alias("node"), "path")


def _all_levels(levels: list[DataFrame], empty: DataFrame) -> DataFrame:
    result = empty
    for level in levels:
        result = result.unionByName(level)
    return result


def _origin(table: Column, schema: str) -> Column:
    return F.concat(F.lit(schema + "."), table)


def impact(events: DataFrame, edges: DataFrame, database: str, schema: str = "BRONZE") -> DataFrame:
    """Per column-level event the artifacts it reaches, with smallest depth and smallest path (taken
    independently of each other)."""
    changes = events.filter(F.col("change_type").isin(*COLUMN_CHANGES)).select(
        "event_id", "change_type", _origin(F.col("table_name"), schema).alias("origin")
    )
    reached = (
        walk(changes.select("origin").distinct(), edges, database)
        .groupBy("origin", *ARTIFACT)
        .agg(F.min("depth").alias("depth"), F.min("path").alias("impact_path"))
    )
    return changes.join(reached, "origin").select(
        "event_id", *ARTIFACT, "depth", "impact_path", is_breaking(F.col("change_type")).alias("is_breaking")
    )


def impact_by_column(events: DataFrame, edges: DataFrame, schema: str = "BRONZE") -> DataFrame:
    """Direct dependents that read the changed column: whole-table readers (`source_columns` NULL) and
    those that list it, which are met by table and column."""
    changes = events.select(
        "event_id", "column_name", _origin(F.col("table_name"), schema).alias("source_table")
    )
    listed = edges.filter(F.col("source_columns").isNotNull()).select(
        "artifact_name", "source_table", F.explode(F.array_distinct("source_columns")).alias("column_name")
    )
    whole = edges.filter(F.col("source_columns").isNull()).select("artifact_name", "source_table")
    shown = ["event_id", "column_name", "artifact_name"]
    return changes.join(listed, ["source_table", "column_name"]).select(*shown).unionByName(
        changes.join(whole, "source_table").select(*shown)
    )


def with_current_sql(impacted: DataFrame, edges: DataFrame) -> DataFrame:
    """Each impacted artifact once, with its current text."""
    texts = edges.groupBy("artifact_name").agg(F.min("artifact_sql").alias("artifact_sql"))
    joined = impacted.select("artifact_name").distinct().join(texts, "artifact_name", "left")
    return joined.withColumn("artifact_sql", F.coalesce("artifact_sql", F.lit("")))


#: Levels that are walked one by one before chains are shortened.
PLAIN_LEVELS = 8


def downstream(tables: DataFrame, edges: DataFrame, database: str) -> DataFrame:
    """Artifacts below any of `tables` (column `origin`), with the largest depth: the order to run them.

    Each level is the set of names reached in so many steps. Graphs of more than PLAIN_LEVELS levels go on by
    `distances`, whose number of jobs grows with the logarithm of a chain. Artifacts that depend on each other have no
    order, which is an error.
    """
    steps = edges.select("artifact_name", "output_fqn", "source_table").distinct()
    names = steps.select("output_fqn").distinct().count()
    start = tables.select(F.col("origin").alias("source_table")).distinct()
    output = without_database(F.col("output_fqn"), database)
    front, levels = start, []
    while len(levels) < PLAIN_LEVELS:
        reached = front.join(steps, "source_table").select("artifact_name", "output_fqn").distinct()
        level = cut(reached.withColumn("run_order", F.lit(len(levels) + 1)), "downstream")
        if level.isEmpty():
            found = _all_levels(levels, level)
            break
        if len(levels) == names:
            raise ValueError("artifacts depend on each other")
        levels.append(level)
        front = level.select(output.alias("source_table")).distinct()
    else:
        links = steps.select(F.col("source_table").alias("src"), output.alias("dst"))
        depths = cut(distances(start.select(F.col("source_table").alias("node")), links, longest=True), "downstream")
        below = depths.select(F.col("node").alias("source_table"), (F.col("depth") + 1).alias("run_order"))
        found = steps.join(below, "source_table").select("artifact_name", "output_fqn", "run_order")
    return found.groupBy("artifact_name", "output_fqn").agg(F.max("run_order").alias("run_order"))


def reach(starts: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes reachable over (src, dst) rows with the smallest number of steps; `starts` (column `node`)
    count as step 0. What lies deeper than PLAIN_LEVELS is found by `distances`, from the last level on."""
    frontier = cut(starts.select("node").distinct().withColumn("depth", F.lit(0)), "reach")
    seen, depth = frontier, 0
    while not frontier.isEmpty():
        if depth == PLAIN_LEVELS:
            # All that earlier levels lead to has been seen, so the way on starts from the last level.
            onward = edges.join(seen.select(F.col("node").alias("dst")), "dst", "left_anti")
            far = distances(frontier.select("node"), onward).filter("depth > 0")
            return cut(seen, "reach").unionByName(far.withColumn("depth", F.col("depth") + depth))
        depth += 1
        reached = (
            edges.join(frontier.select(F.col("node").alias("src")), "src")
            .select(F.col("dst").alias("node"))
            .distinct()
            .join(seen.select("node"), "node", "left_anti")
        )
        frontier = cut(reached.withColumn("depth", F.lit(depth)), "reach")
        seen = seen.unionByName(frontier)
    return seen


def distances(starts: DataFrame, edges: DataFrame, longest: bool = False) -> DataFrame:
    """`node` and `depth`, the number of steps of the shortest way (or the longest) from any of `starts` over (src, dst) rows.

    A node with one edge into it can only be reached through the node before. Such nodes point at the one before, and
    every round doubles how far a pointer reaches, until it meets a start or a node where ways join. One row per node
    is held, and a chain or the height of a tree costs the logarithm of its length. The ways between the nodes that
    are left are then followed by level, each edge with the steps it stands for. A graph without such nodes, as a grid,
    is followed by its levels as before.

    Repeated edges count once; NULL nodes lead nowhere. A cycle has no longest way and is an error then.
    """
    starts = cut(starts.select("node").where("node IS NOT NULL").distinct(), "starts")
    usable = F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.lit(longest) | (F.col("src") != F.col("dst")))
    links = cut(edges.select("src", "dst").where(usable).distinct(), "links")
    into = links.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min("src").alias("up"))
    into = cut(into.join(starts.withColumn("is_start", F.lit(True)), "node", "left"), "into")
    joint = into.filter((F.col("n") > 1) | F.col("is_start")).select("node")
    pointers = _jumped(cut(into.filter("n = 1 AND is_start IS NULL").select("node", "up"), "single"))

    # Where ways join, an edge stands for all steps from the start or joint above it. Of pointers that end nowhere, on
    # cycles without an entry, nothing can be reached.
    farther = F.max if longest else F.min
    above = pointers.select(F.col("node").alias("src"), "up", "steps", "ended")
    ways = cut(
        links.join(joint.select(F.col("node").alias("dst")), "dst", "left_semi")
        .join(above, "src", "left")
        .filter(F.col("ended").isNull() | F.col("ended"))
        .groupBy(F.coalesce("up", "src").alias("src"), "dst")
        .agg(farther(F.coalesce("steps", F.lit(0)) + 1).alias("steps")),
        "ways",
    )
    limit = joint.unionByName(starts).distinct().count()
    best = cut(_followed(starts, ways, longest, limit), "best")
    inner = pointers.filter("ended").join(best.withColumnRenamed("node", "up"), "up")
    return best.unionByName(inner.select("node", (F.col("depth") + F.col("steps")).alias("depth")))


def _jumped(single: DataFrame) -> DataFrame:
    """For nodes with one node before them (`node`, `up`): the first above that is none of them (`up`), and the steps to it.

    A round in which no pointer ends leaves only those that go round in cycles; they keep `ended` false.
    """
    held = single.select(F.col("node").alias("up"), F.lit(True).alias("inner"))
    pointers = cut(single.join(held, "up", "left").select("node", "up", F.lit(1).alias("steps"), F.col("inner").isNull().alias("ended")), "pointers")
    before, open_ = None, pointers.filter("NOT ended").count()
    while open_ and open_ != before:
        onward = pointers.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("ended").alias("ends"))
        moved = pointers.filter("NOT ended").join(onward, "up").select(
            "node", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), F.col("ends").alias("ended")
        )
        pointers = cut(pointers.filter("ended").unionByName(moved), "pointers")
        before, open_ = open_, pointers.filter("NOT ended").count()
    return pointers


def _followed(starts: DataFrame, ways: DataFrame, longest: bool, limit: int) -> DataFrame:
    """`node` and best `depth` over (src, dst, steps) rows; each round goes on from what the last one has bettered."""
    best_of = F.max if longest else F.min
    front = cut(starts.select("node", F.lit(0).alias("depth")), "followed")
    found, rounds = front, 0
    while not front.isEmpty():
        if longest and rounds > limit:
            raise ValueError("artifacts depend on each other")
        rounds += 1
        reached = (
            ways.join(front.withColumnRenamed("node", "src"), "src")
            .groupBy(F.col("dst").alias("node")).agg(best_of(F.col("depth") + F.col("steps")).alias("depth"))
        )
        held = found.groupBy("node").agg(best_of("depth").alias("held"))
        better = F.col("depth") > F.col("held") if longest else F.col("depth") < F.col("held")
        front = cut(reached.join(held, "node", "left").filter(F.col("held").isNull() | better).select("node", "depth"), "followed")
        found = found.unionByName(front)
        if rounds % 16 == 0:  # one table instead of many, so that the plan stays short
            found = cut(found.groupBy("node").agg(best_of("depth").alias("depth")), "followed")
    return found.groupBy("node").agg(best_of("depth").alias("depth"))


def impact_report(events: DataFrame, impacted: DataFrame, specs: DataFrame | None = None) -> DataFrame:
    """What each event means, as rows (event_id, part, place, name, report) with a JSON text each.

    Every event has one row `event`. A column-level event has a row `impacted` for each artifact it reaches, placed
    by depth. A new table's event says how to generate its model, and has a row `column` for each of its
    columns (`specs`, see `new_table_spec`), if any are known. An unknown change type gives an error text.
    """

    def text(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(""))

    def rows(df: DataFrame, part: str, place: Column, name: Column, report: Column) -> DataFrame:
        return df.select(
            "event_id", F.lit(part).alias("part"), place.cast("int").alias("place"), name.alias("name"), report.alias("report")
        )

    kind, none, top = F.col("change_type"), F.lit(""), F.lit(0)
    column_event = F.struct(
        "event_id", "table_name", text("column_name").alias("column_name"), "change_type",
        text("old_data_type").alias("old_type"), text("new_data_type").alias("new_type"),
        is_breaking(kind).alias("is_breaking"),
    )
    changed = events.filter(kind.isin(*COLUMN_CHANGES))
    other = events.filter(~F.coalesce(kind.isin(*COLUMN_CHANGES, NEW_TABLE), F.lit(False)))
    unknown = F.struct(F.concat(F.lit("Unknown change_type: "), F.coalesce(kind, none)).alias("error"))
    item = F.struct("artifact_name", "artifact_type", "file_path", "output_fqn", "depth", "impact_path")
    created = events.filter(kind == NEW_TABLE)
    keys = None if specs is None else specs.groupBy("table_name").agg(F.max("primary_key").alias("primary_key"))
    keyed = created.withColumn("primary_key", F.lit(None).cast("string")) if keys is None else created.join(cut(keys, "keys"), "table_name", "left")
    table_event = F.struct(
        "event_id", "table_name", F.lit("").alias("column_name"), F.lit(NEW_TABLE).alias("change_type"),
        F.lit(False).alias("is_breaking"),
    )
    generate = F.struct(
        F.lit("CREATE").alias("action"), silver_model_path(F.col("table_name")).alias("silver_model_path"),
        F.lit("models/sources.yml").alias("sources_yml_path"), "primary_key",
    )
    new = F.to_json(F.struct(table_event.alias("event"), generate.alias("generate")), {"ignoreNullFields": "false"})
    result = (
        rows(changed, "event", top, none, F.to_json(F.struct(column_event.alias("event"))))
        .unionByName(rows(other, "event", top, none, F.to_json(unknown)))
        .unionByName(rows(impacted, "impacted", F.col("depth"), F.col("artifact_name"), F.to_json(item)))
        .unionByName(rows(keyed, "event", top, none, new))
    )
    if specs is None:
        return result
    columns = created.select("event_id", "table_name").join(specs, "table_name")
    named = F.struct(F.col("column_name").alias("name"), F.col("data_type").alias("type"))
    return result.unionByName(rows(columns, "column", F.col("ordinal_position"), F.col("column_name"), F.to_json(named)))


def silver_model_path(table: Column) -> Column:
    return F.concat(F.lit("models/silver/"), F.lower(table), F.lit(".sql"))
