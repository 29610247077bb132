"""A Merkle manifest of a data set, with a proof for every row.

Each node is labelled with the interval of leaf places that it covers; intervals nest. A level's nodes are found by
the bucket of their places, `lo` divided by the width of a node of that level. Ancestors are attached from the top
down: a node meets its parent in the parent's bucket, where the parent's interval holds its own. What the parent's
interval holds beside a node's own are its siblings: those that end before it lie left of it, those that start behind
it lie right. A join has one parent and at most `fan` children for a key, also in a tree that holds most rows.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut

from .ranks import ranked

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(column: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of a text in UTF-8."""
    return F.sha2(column.cast("binary"), 256)


def leaf(fields: dict[str, Column]) -> Column:
    """The digest of the fields one after another: `-` for null, else the number of bytes, a colon and the value as text."""
    texts = [value.cast("string") for value in fields.values()]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def levels(leaves: DataFrame, fan: int = FAN) -> list[DataFrame]:
    """The inner nodes of all trees, a stored table for each level, lowest first.

    `leaves` has `tree`, `total` (leaves of the tree), `at` (place in the tree), `digest`, and further columns that go with a
    leaf. A node has its label `lo` and `hi`, its `bucket`, its `digest` and its `children` in order, each with label
    and digest, on the lowest level with the further columns too. A tree ends at the level where one node holds all.
    """
    most = leaves.agg(F.max("total")).first()[0] or 0
    extra = [c for c in leaves.columns if c not in ("tree", "total", "at", "digest")]
    nodes = leaves.select("tree", "total", F.col("at").alias("lo"), (F.col("at") + 1).alias("hi"), "digest", *extra)
    found, width = [], 1
    while width < most:
        bucket = F.floor(F.col("lo") / (width * fan)).alias("bucket")
        child = F.struct("lo", "hi", "digest", *(extra if width == 1 else []))
        runs = nodes.where(F.col("total") > width).groupBy("tree", "total", bucket).agg(F.array_sort(F.collect_list(child)).alias("children"))
        joined = F.array_join(F.transform("children", lambda c: c["digest"]), "")
        runs = runs.select(
            "tree", "total", "bucket", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"), "children", digest(joined).alias("digest")
        )
        found.append(cut(runs, "manifest-level"))
        nodes, width = found[-1], width * fan
    return found


def subroots(leaves: DataFrame, runs: list[DataFrame], fan: int = FAN) -> DataFrame:
    """`tree` and the `digest` of its topmost node; that of a tree with one leaf is the leaf."""
    tops = [leaves.where("total = 1")] + [level.where(F.col("total") <= fan ** (k + 1)) for k, level in enumerate(runs)]
    return reduce(DataFrame.union, [t.where(F.col("total") > (fan**k if k else 0)).select("tree", "digest") for k, t in zip([0, *range(len(runs))], tops)])


def siblings(lo: Column, hi: Column, children: str = "children") -> Column:
    """What `children` hold outside of the interval from `lo` to `hi`, as joined digests: `left` of it and `right` of it."""

    def side(keep):
        return F.array_join(F.transform(F.filter(children, keep), lambda c: c["digest"]), "")

    return F.struct(side(lambda c: c["hi"] <= lo).alias("left"), side(lambda c: c["lo"] >= hi).alias("right"))


def proofs(leaves: DataFrame, runs: list[DataFrame], above: DataFrame, fan: int = FAN) -> DataFrame:
    """Each leaf's further columns with `digest`, `subroot`, `root` and `path`: its siblings (`left`, `right`) from its own level up to the root.

    `above` has for each `tree` the `path` of its subroot and the `root`.
    """
    extra = [c for c in leaves.columns if c not in ("tree", "total", "at", "digest")]
    start = above.select(F.col("tree").alias("start_tree"), "path", "root")

    def tops(nodes: DataFrame, *columns: str) -> DataFrame:
        return nodes.join(start, F.col("tree").eqNullSafe(F.col("start_tree"))).select(*columns, F.col("digest").alias("subroot"), "root", "path")

    labelled = ("tree", "lo", "hi", "bucket", "children")
    known = None
    for k in reversed(range(len(runs))):
        width = fan ** (k + 1)
        here = tops(runs[k].where(F.col("total") <= width), *labelled)
        if known is not None:
            parent = known.select(
                F.col("tree").alias("p_tree"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), F.col("bucket").alias("p_bucket"), F.col("children").alias("p_children"),
                "subroot", "root", F.col("path").alias("p_path"),
            )
            same_bucket = F.col("tree").eqNullSafe(F.col("p_tree")) & (F.floor(F.col("lo") / (width * fan)) == F.col("p_bucket"))
            inside = (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
            own = siblings(F.col("lo"), F.col("hi"), "p_children")
            lower = runs[k].where(F.col("total") > width).join(parent, same_bucket & inside)
            here = here.union(lower.select(*labelled, "subroot", "root", F.concat(F.array(own), "p_path").alias("path")))
        known = here
    single = tops(leaves.where("total = 1"), *extra, "digest")
    if known is None:
        return single
    each = known.select("children", "subroot", "root", "path", F.explode("children").alias("c"))
    path = F.concat(F.array(siblings(F.col("c.lo"), F.col("c.hi"))), "path")
    return single.union(each.select(*[F.col("c")[e].alias(e) for e in extra], F.col("c.digest").alias("digest"), "subroot", "root", path.alias("path")))


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and its siblings on each level."""
    return F.aggregate(path, start, lambda acc, p: digest(F.concat(p["left"], acc, p["right"])))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def lowered(text: str = "text") -> Column:
    """The text with A-Z as a-z and all else as it is."""
    return F.translate(F.col(text), ascii_uppercase, ascii_lowercase)


def chosen(doc_id: str = "doc_id", parts: int = 3) -> Column:
    """Whether the crc32 of the id as text is divisible by `parts`; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == 0, F.lit(False))


def manifest(docs: DataFrame, altered: Column | None = None, changed: Column | None = None, fan: int = FAN) -> DataFrame:
    """`doc_id`, `leaf`, `subroot`, `root`, `path`, `proof_sha256`, `folded_root` and `verified` of every row of `docs`.

    The rows of a language are the leaves of its tree in the order of their ids, null first, then of their digests; a
    null language is a tree too. The languages' subroots, null first and then bytewise, are the leaves of the top
    tree. `folded_root` follows from the leaf as it is found now: of a row for which `changed` is true the text is
    now `altered`. `verified` says whether that gives the root of the untampered rows.

    Null fields have a mark of their own, so a null text and an empty one differ. Rows that repeat are leaves with equal
    digests and proofs of their own places. Long texts cost their two digests. An empty table gives no row; other
    columns do not matter. Nothing but the size of the largest tree reaches the driver.
    """
    before = {f: F.col(f) for f in FIELDS}
    # A row that is not changed has one digest to compute.
    current = F.lit(None).cast("string") if altered is None else F.when(F.lit(True) if changed is None else changed, leaf({**before, "text": altered}))
    rows = cut(docs.select(F.col("lang").alias("tree"), "doc_id", leaf(before).alias("digest"), current.alias("current")), "manifest-leaves")
    leaves = cut(ranked(rows, "tree", ["doc_id", "digest"]), "manifest-ranked")
    runs = levels(leaves, fan)
    tops = cut(subroots(leaves, runs, fan).select(F.lit(0).alias("tree"), F.col("tree").alias("name"), "digest"), "manifest-subroots")
    top_leaves = cut(ranked(tops, "tree", ["name"]), "manifest-top")
    top_runs = levels(top_leaves, fan)
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    root = subroots(top_leaves, top_runs, fan).select("tree", no_path.alias("path"), F.col("digest").alias("root"))
    above = cut(proofs(top_leaves, top_runs, root, fan).select(F.col("name").alias("tree"), "path", "root"), "manifest-above")
    proved = proofs(leaves, runs, above, fan)
    again = folded(F.coalesce("current", "digest"), F.col("path"))
    return proved.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", proof_digest(F.col("path")).alias("proof_sha256"), again.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )
