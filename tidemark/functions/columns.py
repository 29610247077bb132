"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    BRANCH_PREFIX,
    BREAKING,
    CONNECTOR_COLUMNS,
    CONNECTOR_PREFIXES,
    DROP_SUFFIX,
    JOURNAL_INFIX,
    JSON_OPTIONS,
    LOOK_BACK_MINUTES,
    PRIORITY,
    REVIEW_NUMBER,
    WHITE_SPACE,
)


def any_of(tests: Sequence[Column]) -> Column:
    result = tests[0]
    for test in tests[1:]:
        result = result | test
    return result


def is_true(flag: Column) -> Column:
    """Three-valued flag to two values: NULL counts as false."""
    return F.coalesce(flag, F.lit(False))


def has_connector_prefix(name: Column) -> Column:
    """Literal prefixes: an underscore stands for itself, so a column PAYLOAD_ID stays."""
    return any_of([name.startswith(p) for p in CONNECTOR_PREFIXES])


def is_drop_marker(name: Column) -> Column:
    return name.endswith(DROP_SUFFIX)


def without_drop_suffix(name: Column) -> Column:
    """Every occurrence goes, not only the last."""
    return F.replace(name, F.lit(DROP_SUFFIX), F.lit(""))


def is_journal(table: Column) -> Column:
    return table.contains(JOURNAL_INFIX)


def is_business_column(name: Column, listed: bool = True, markers: bool = True) -> Column:
    """Not the connector's own column. `listed` also excludes the five fixed names, `markers=False`
    also excludes drop markers."""
    keep = ~has_connector_prefix(name)
    if listed:
        keep = keep & ~name.isin(*CONNECTOR_COLUMNS)
    if not markers:
        keep = keep & ~is_drop_marker(name)
    return keep


def looks_like_key(name: Column) -> Column:
    return F.lower(name).endswith("_id")


def priority(change_type: Column) -> Column:
    return _ranked(change_type, 0)


def priority_rank(change_type: Column) -> Column:
    return _ranked(change_type, 1)


def _ranked(change_type: Column, part: int) -> Column:
    pairs = [F.lit(x) for kind, value in PRIORITY.items() for x in (kind, value[part])]
    return F.create_map(*pairs)[change_type]


def is_breaking(change_type: Column) -> Column:
    return change_type.isin(*BREAKING)


def day(moment: Column, data_type: str) -> Column:
    """Start of day, in the type that came in. Only an instant needs the session's time zone for that."""
    if data_type == "timestamp":
        return F.date_trunc("day", moment)
    return moment.cast("date").cast(data_type)


def minutes_before(now: Column, minutes: int = LOOK_BACK_MINUTES) -> Column:
    return now - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def name_part(dotted: Column, n: int) -> Column:
    """n-th part (from 1) of a dotted name."""
    return F.split_part(dotted, F.lit("."), F.lit(n))


def without_database(fqn: Column, database: str) -> Column:
    return F.replace(fqn, F.lit(database + "."), F.lit(""))


def strip(text: Column) -> Column:
    """White space of any kind off both ends; trim alone takes blanks only."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once per row, however often the result names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def json_items(text: Column, item: str) -> Column:
    """The JSON values in a text, parsed as the items of an array; NULL if they do not parse. Texts of any size are read."""
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{item}>", JSON_OPTIONS)


def ends_with_value(text: Column) -> Column:
    """Is nothing behind the first JSON value but what may follow the value of a field?"""
    field = F.from_json(
        F.concat(F.lit('{"v":'), text, F.lit("}")), "v string, broken string",
        {**JSON_OPTIONS, "columnNameOfCorruptRecord": "broken"},
    )
    return field["broken"].isNull()


def is_whole_json(text: Column) -> Column:
    """Is the text exactly one JSON value?

    The parser alone stops after the first value. Text that is one value as an array item and also as an
    object field has nothing behind it.
    """
    single = F.size(json_items(text, "string")) == 1
    return F.coalesce(single, F.lit(False)) & F.coalesce(ends_with_value(text), F.lit(False))


def row_id(*columns: Column | str) -> Column:
    """Stable id from values, so that a retried write gives the same row. NULL and empty text differ."""
    values = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.sha2(F.to_json(F.array(*values)), 256)


def branch_label(change_type: Column, table: Column, column: Column) -> Column:
    """`schema-change/<type>-<table>-<column>`, lower case but for the column."""
    named = F.coalesce(F.nullif(column, F.lit("")), F.lit("newtable"))
    label = F.concat(F.lit(BRANCH_PREFIX), F.lower(change_type), F.lit("-"), F.lower(table), F.lit("-"), named)
    return F.regexp_replace(label, "-+$", "")


def short_branch_label(event_id: Column) -> Column:
    """For display; the branch itself has the whole id."""
    return F.concat(F.lit(BRANCH_PREFIX), F.substring(event_id, 1, 8))


def branch_of(event_id: Column) -> Column:
    return F.concat(F.lit(BRANCH_PREFIX), event_id)


def review_title(change_type: Column, table: Column, column: Column) -> Column:
    """`[schema-change] <type> on <table>.<column>` without trailing dots."""
    named = F.coalesce(column, F.lit(""))
    title = F.concat(F.lit("[schema-change] "), change_type, F.lit(" on "), table, F.lit("."), named)
    return F.regexp_replace(title, r"\.+$", "")


def review_number(url: Column) -> Column:
    """Number of the review in its address; NULL if there is none."""
    return F.nullif(F.regexp_extract(url, REVIEW_NUMBER, 1), F.lit("")).cast("bigint")


def rewrite(text: Column, pattern: str, groups: Sequence[int], replace: Callable[..., Column]) -> Column:
    """Replace every match of `pattern` by `replace(match, group, ...)`.

    The text is cut at the matches and put together again: two passes over it whatever the number of
    groups, which are read from the short matches, and no UDF.
    """
    def rebuilt(source: Column, found: Column) -> Column:
        filled = F.transform(
            found, lambda m: replace(m, *[F.regexp_extract(m, pattern, g) for g in groups])
        )
        between = F.split(source, pattern, -1)
        glued = F.zip_with(between, filled, lambda left, right: F.concat(left, F.coalesce(right, F.lit(""))))
        return F.when(F.size(found) > 0, F.array_join(glued, "")).otherwise(source)

    return let(
        text, lambda source: let(F.regexp_extract_all(source, F.lit(pattern), F.lit(0)), lambda m: rebuilt(source, m))
    )
