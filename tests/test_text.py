from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions.columns import is_whole_json, rewrite
from tidemark.session import local_rows


def one(spark, build, *values):
    df = local_rows(spark, [values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(build(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("```sql\nSELECT 1\n```", "SELECT 1"),
        ("  ```\nSELECT 1```  ", "SELECT 1"),
        ("```SELECT 1", "1"),
        ("SELECT 1\n", "SELECT 1"),
        ('"SELECT \\n \\"x\\" \\u00e9"', 'SELECT \n "x" é'),
        ('```\n"a\\tb"\n```', "a\tb"),
        ('"bad \\q escape"', '"bad \\q escape"'),
        ('"a", "b"', '"a", "b"'),
        ('"', '"'),
        ('""', ""),
        ("", ""),
        ("a ``` b", "a ``` b"),
    ],
)
def test_strip_fence(spark, text, want):
    assert one(spark, X.strip_fence, text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Hi\n```sql\n{{ config() }} SELECT 1\n```\nbye ```x\ny```", "{{ config() }} SELECT 1"),
        ("Hi {{ a }} b ", "{{ a }} b"),
        ("{{ a }}", "{{ a }}"),
        ("no block", "no block"),
        ("```sql SELECT```", "```sql SELECT```"),
    ],
)
def test_extract_block(spark, text, want):
    assert one(spark, X.extract_block, text) == want


@pytest.mark.parametrize(
    ("original", "generated", "want"),
    [
        (" {{\n config(a) }} SELECT {{ x }}", " SELECT 2 ", "{{\n config(a) }}\n\nSELECT 2"),
        ("{{ c }} x", " {{ d }} SELECT 2 ", " {{ d }} SELECT 2 "),
        ("SELECT {{ x }}", " SELECT 2 ", " SELECT 2 "),
    ],
)
def test_restore_header(spark, original, generated, want):
    assert one(spark, X.restore_header, original, generated) == want


@pytest.mark.parametrize(
    ("original", "generated", "want"),
    [
        ("FROM {{ ref('orders') }} JOIN {{ref( \"Items\" )}}",
         "FROM {{ source('bronze', 'ORDERS') }} JOIN {{ source('x','items') }} , {{ source('a', 'other') }}",
         "FROM {{ ref('orders') }} JOIN {{ref( \"Items\" )}} , {{ source('a', 'other') }}"),
        ("no refs", "FROM {{ source('a', 'orders') }}", "FROM {{ source('a', 'orders') }}"),
        ("{{ ref('a') }} {{ ref('A') }}", "{{ source('z', 'a') }}", "{{ ref('A') }}"),
        ("{{ ref('a') }}", "nothing", "nothing"),
    ],
)
def test_restore_refs(spark, original, generated, want):
    assert one(spark, X.restore_refs, original, generated) == want


def test_lower_sources(spark):
    text = "{{ source('BRONZE','Orders') }} {{source( \"B\" , 'C' )}} {{ ref('Keep') }} source('A','B')"
    want = "{{ source('bronze','orders') }} {{source( \"b\" , 'c' )}} {{ ref('Keep') }} source('A','B')"
    assert one(spark, X.lower_sources, text) == want


def test_compile(spark):
    text = """{{
      config(database = var('db_name'), schema = 'GOLD')
    }}
    SELECT * FROM {{ ref('orders') }} o JOIN {{ source("bronze", "items") }} i, {{ var('db_name') }}.X.Y, {{ other() }}
    """
    want = "SELECT * FROM DEV.SILVER.ORDERS o JOIN DEV.BRONZE.ITEMS i, DEV.X.Y, {{ other() }}"
    assert one(spark, lambda c: X.compile_model(c, "DEV"), text) == want


@pytest.mark.parametrize("text", ["", "a1b22c", "1", "11a", "a", "x1", "1x1", "é1ß22"])
def test_rewrite_equals_sub(spark, text):
    got = one(spark, lambda c: rewrite(c, r"(\d)(\d?)", [1, 2], lambda m, a, b: F.concat(F.lit("<"), b, a, F.lit(">"))), text)
    assert got == re.sub(r"(\d)(\d?)", lambda m: f"<{m.group(2)}{m.group(1)}>", text)


@pytest.mark.parametrize(
    "text",
    ['{"k": 1}', '{"k": 1} end', '{"k": 1}{"k": 2}', '"a", "b"', '"a", "b": 1', '{"a": 1}], [1', "1}, {", "[1, 2]", "",
     "null", '"x"', "{", "1 2", ' {"k": [null]} ', '{"k": 1},'],
)
def test_whole_json(spark, text):
    try:
        json.loads(text)
        want = True
    except ValueError:
        want = False
    assert one(spark, is_whole_json, text) == want


def test_long_text_stays_whole(spark):
    body = "word 'quoted' {{ source('A', 'B') }} \\ $1 " * 20000
    assert one(spark, X.lower_sources, body) == body.replace("source('A', 'B')", "source('a', 'b')")
    assert one(spark, X.strip_fence, "```sql\n" + json.dumps(body) + "\n```") == body


def test_text_of_40_million_characters(spark):
    n = 40_000_000
    text = F.concat(F.lit('"'), F.repeat(F.lit("x"), F.lit(n)), F.lit('"'))
    df = spark.range(1).select(text.alias("t"))
    row = df.select(F.length(X.strip_fence(F.col("t"))), is_whole_json(F.col("t"))).first()
    assert tuple(row) == (n, True)
