"""Cleaning of generated model text, column by column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    ANY_SOURCE_CALL,
    CLOSE_FENCE,
    CONFIG_BLOCK,
    DB_VARIABLE,
    FENCED_BLOCK,
    HEADER_BLOCK,
    OPEN_FENCE,
    REF_CALL,
    SOURCE_CALL,
    SOURCE_CALL_PARTS,
)
from .columns import ends_with_value, json_items, let, rewrite, strip


def strip_fence(text: Column) -> Column:
    """Take off an outer code fence, then decode the text if it is one JSON string."""

    def unfenced(bare: Column) -> Column:
        inner = strip(F.regexp_replace(F.regexp_replace(bare, OPEN_FENCE, ""), CLOSE_FENCE, ""))
        return F.when(bare.startswith("```"), inner).otherwise(bare)

    def decoded(body: Column) -> Column:
        quoted = (F.length(body) >= 2) & body.startswith('"') & body.endswith('"')
        single = let(json_items(body, "string"), lambda items: F.when(F.size(items) == 1, F.get(items, F.lit(0))))
        value = F.when(quoted & ends_with_value(body), single)
        return F.coalesce(value, body)

    return let(strip(text), lambda bare: let(unfenced(bare), decoded))


def extract_block(text: Column) -> Column:
    """First fenced block if there is one, then from the first `{{` on."""

    def unfenced(bare: Column) -> Column:
        fenced = F.regexp_like(bare, F.lit(FENCED_BLOCK))
        return F.when(fenced, strip(F.regexp_extract(bare, FENCED_BLOCK, 1))).otherwise(bare)

    def from_first_call(body: Column) -> Column:
        start = F.instr(body, "{{")
        return strip(F.when(start > 1, F.substring(body, start, F.length(body))).otherwise(body))

    return let(strip(text), lambda bare: let(unfenced(bare), from_first_call))


def restore_header(original: Column, generated: Column) -> Column:
    """Put the original's leading `{{ ... }}` block back if the new text does not start with one."""

    def restored(bare: Column) -> Column:
        header = F.regexp_extract(strip(original), HEADER_BLOCK, 1)
        lost = let(header, lambda h: F.when(h != "", F.concat(h, F.lit("\n\n"), bare)).otherwise(generated))
        return F.when(bare.startswith("{{"), generated).otherwise(lost)

    return let(strip(generated), restored)


def restore_refs(original: Column, generated: Column) -> Column:
    """A `source()` call on a name the original reached by `ref()` becomes that `ref()` again."""
    found = F.regexp_extract_all(original, F.lit(REF_CALL), F.lit(0))
    # A name the original used twice keeps its last spelling.
    calls = F.reverse(found)

    def put_back(calls: Column, names: Column) -> Column:
        def chosen(call: Column, table: Column) -> Column:
            place = F.array_position(names, F.lower(table)).cast("int")
            return F.when(place > 0, F.get(calls, place - 1)).otherwise(call)

        return rewrite(generated, ANY_SOURCE_CALL, [1], chosen)

    def name_of(call: Column) -> Column:
        return F.lower(F.regexp_extract(call, REF_CALL, 1))

    return let(calls, lambda c: let(F.transform(c, name_of), lambda names: put_back(c, names)))


def lower_sources(text: Column) -> Column:
    """Both arguments of every `source()` call in lower case."""
    return rewrite(
        text,
        SOURCE_CALL_PARTS,
        [1, 2, 3, 4, 5],
        lambda _, a, schema, b, table, c: F.concat(a, F.lower(schema), b, F.lower(table), c),
    )


def compile_model(text: Column, database: str, ref_layer: str = "SILVER") -> Column:
    """Template calls to plain names: sources to DB.SCHEMA.TABLE, refs to DB.<layer>.MODEL."""
    body = F.regexp_replace(text, CONFIG_BLOCK, "")
    body = rewrite(
        body,
        SOURCE_CALL,
        [1, 2],
        lambda _, schema, table: F.concat(F.lit(database + "."), F.upper(schema), F.lit("."), F.upper(table)),
    )
    body = rewrite(body, REF_CALL, [1], lambda _, m: F.concat(F.lit(f"{database}.{ref_layer}."), F.upper(m)))
    return strip(F.regexp_replace(body, DB_VARIABLE, database))
