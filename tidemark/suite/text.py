"""Scalar functions, JSON, and cleaning of generated model text over whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import text as X
from .base import query, table


@query(
    "scalar_strings",
    """
    SELECT p_partkey, upper(p_name) AS upper_name, lower(p_brand) AS lower_brand, trim('  ' || p_type || ' ') AS trimmed,
        replace(p_name, ' ', '__') AS replaced, rtrim(p_brand || '...', '.') AS right_stripped,
        substr(p_name, 1, 8) AS first_eight, split_part('a.' || p_brand || '.c', '.', 2) AS middle,
        to_base64(encode(p_name)) AS encoded, decode(from_base64(to_base64(encode(p_name)))) AS decoded,
        COALESCE(NULLIF(p_type, 'SMALL'), 'none') AS nvl_type FROM part
    """,
)
def scalar_strings(spark: SparkSession, sf: str) -> DataFrame:
    name, brand = F.col("p_name"), F.col("p_brand")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.upper(name).alias("upper_name"),
        F.lower(brand).alias("lower_brand"),
        F.trim(F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))).alias("trimmed"),
        F.replace(name, F.lit(" "), F.lit("__")).alias("replaced"),
        F.regexp_replace(F.concat(brand, F.lit("...")), r"\.+$", "").alias("right_stripped"),
        F.substring(name, 1, 8).alias("first_eight"),
        C.name_part(F.concat(F.lit("a."), brand, F.lit(".c")), 2).alias("middle"),
        F.base64(name).alias("encoded"),
        F.decode(F.unbase64(F.base64(name)), "UTF-8").alias("decoded"),
        F.nvl(F.nullif(F.col("p_type"), F.lit("SMALL")), F.lit("none")).alias("nvl_type"),
    )


@query(
    "json_props",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
        '{"event_type":"' || event_type || '","k":' || json_extract(props, '$.k') || '}' AS rebuilt FROM events
    """,
)
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    value = F.get(C.json_items(F.col("props"), "struct<k: int>"), F.lit(0))["k"]
    return table(spark, sf, "events").select(
        "event_id", value.alias("k"), F.to_json(F.struct("event_type", value.alias("k"))).alias("rebuilt")
    )


_LINES = """(SELECT event_id, CASE event_type WHEN 'click' THEN props WHEN 'view' THEN 'noise ' || props
    WHEN 'error' THEN CASE WHEN value < 50 THEN substr(props, 1, length(props) - 1) ELSE props || ' end' END WHEN 'purchase' THEN '  ' || props || '  '
    ELSE '[' || props || ']' END AS line FROM events)"""


@query(
    "json_lines",
    f"""
    SELECT event_id, CAST(json_extract(line, '$.k') AS INTEGER) AS k FROM (SELECT event_id, trim(line) AS line FROM {_LINES})
    WHERE starts_with(line, '{{') AND json_valid(line)
    """,
)
def json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines among other text; lines that do not parse are skipped."""
    kind, props = F.col("event_type"), F.col("props")
    line = (
        F.when(kind == "click", props)
        .when(kind == "view", F.concat(F.lit("noise "), props))
        .when((kind == "error") & (F.col("value") < 50), F.substring(props, F.lit(1), F.length(props) - 1))
        .when(kind == "error", F.concat(props, F.lit(" end")))
        .when(kind == "purchase", F.concat(F.lit("  "), props, F.lit("  ")))
        .otherwise(F.concat(F.lit("["), props, F.lit("]")))
    )
    lines = table(spark, sf, "events").select("event_id", F.trim(line).alias("line"))
    kept = lines.filter(F.col("line").startswith("{") & C.is_whole_json(F.col("line")))
    return kept.select("event_id", F.get(C.json_items(F.col("line"), "struct<k: int>"), F.lit(0))["k"].alias("k"))


# Every document is wrapped the way a model's answer or a model file would hold it.
_FENCED = """CASE lang WHEN 'en' THEN '```sql' || chr(10) || text || chr(10) || '```'
    WHEN 'fr' THEN chr(10) || ' ```' || text || '``` ' ELSE CAST(to_json(text) AS VARCHAR) END"""
_STRIP = "regexp_replace(regexp_replace({0}, '^\\s+', ''), '\\s+$', '')"


def _stripped(sql: str) -> str:
    return _STRIP.format(sql)


@query(
    "text_strip_fence",
    f"""
    SELECT doc_id, CASE WHEN starts_with(inner_text, '"') AND ends_with(inner_text, '"') AND length(inner_text) >= 2
            AND json_valid(inner_text) THEN json_extract_string(inner_text, '$') ELSE inner_text END AS body
    FROM (SELECT doc_id, CASE WHEN starts_with(t, '```') THEN {_stripped("regexp_replace(regexp_replace(t, '^```[a-zA-Z]*\\n?', ''), '\\n?```$', '')")}
            ELSE t END AS inner_text
        FROM (SELECT doc_id, {_stripped(_FENCED)} AS t FROM documents))
    """,
)
def text_strip_fence(spark: SparkSession, sf: str) -> DataFrame:
    text, lang = F.col("text"), F.col("lang")
    answer = (
        F.when(lang == "en", F.concat(F.lit("```sql\n"), text, F.lit("\n```")))
        .when(lang == "fr", F.concat(F.lit("\n ```"), text, F.lit("``` ")))
        .otherwise(_as_json_string(text))
    )
    return table(spark, sf, "documents").select("doc_id", X.strip_fence(answer).alias("body"))


def _as_json_string(text: Column) -> Column:
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


_CHATTY = """CASE source WHEN 'src0' THEN 'Sure, here it is:' || chr(10) || '```sql' || chr(10)
        || 'note {{ config() }} SELECT ' || text || '```' || chr(10) || 'Anything else?'
    WHEN 'src1' THEN 'Answer: {{ config() }}' || chr(10) || text ELSE text END"""


@query(
    "text_extract_block",
    f"""
    SELECT doc_id, {_stripped("CASE WHEN contains(b, '{{') THEN substr(b, instr(b, '{{')) ELSE b END")} AS body FROM (
        SELECT doc_id, CASE WHEN regexp_matches(t, '(?s)```[a-zA-Z]*\\n(.*?)```')
            THEN {_stripped("regexp_extract(t, '(?s)```[a-zA-Z]*\\n(.*?)```', 1)")} ELSE t END AS b
        FROM (SELECT doc_id, {_stripped(_CHATTY)} AS t FROM documents))
    """,
)
def text_extract_block(spark: SparkSession, sf: str) -> DataFrame:
    text, source = F.col("text"), F.col("source")
    fenced = F.concat(F.lit("Sure, here it is:\n```sql\nnote {{ config() }} SELECT "), text,
                      F.lit("```\nAnything else?"))
    chatty = (
        F.when(source == "src0", fenced)
        .when(source == "src1", F.concat(F.lit("Answer: {{ config() }}\n"), text))
        .otherwise(text)
    )
    return table(spark, sf, "documents").select("doc_id", X.extract_block(chatty).alias("body"))


@query(
    "text_restore_header",
    f"""
    SELECT doc_id, CASE WHEN lang = 'en' THEN '  {{{{ kept() }}}} ' || text
        WHEN lang = 'fr' THEN text
        ELSE '{{{{' || chr(10) || 'config(' || source || ') }}}}' || chr(10) || chr(10) || {_stripped('text')} END AS body
    FROM documents
    """,
)
def text_restore_header(spark: SparkSession, sf: str) -> DataFrame:
    """English texts still have a header, French originals never had one, the others lost theirs."""
    text, lang = F.col("text"), F.col("lang")
    header = F.concat(F.lit(" {{\nconfig("), F.col("source"), F.lit(") }} {{ more }} "))
    original = F.when(lang == "fr", text).otherwise(F.concat(header, text))
    generated = F.when(lang == "en", F.concat(F.lit("  {{ kept() }} "), text)).otherwise(text)
    return table(spark, sf, "documents").select("doc_id", X.restore_header(original, generated).alias("body"))


@query(
    "text_restore_refs",
    """
    SELECT doc_id, text || ' FROM {{ ref("' || source || '") }} a JOIN ' || CASE WHEN lang = 'en'
            THEN '{{ ref(''en'') }}' ELSE '{{ source(''bronze'', ''' || upper(lang) || ''') }}' END
        || ' b JOIN {{ ref("' || source || '") }} c ' || text AS body FROM documents
    """,
)
def text_restore_refs(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's own source, and `en`, were reached by `ref()` in the original."""
    text, source, lang = F.col("text"), F.col("source"), F.col("lang")
    original = F.concat(F.lit('SELECT 1 FROM {{ ref("'), source, F.lit("\") }} JOIN {{ ref('en') }}"))
    own = F.concat(F.lit("{{ source('BRONZE', '"), F.upper(source), F.lit("') }}"))
    generated = F.concat(
        text, F.lit(" FROM "), own, F.lit(" a JOIN {{ source('bronze', '"), F.upper(lang), F.lit("') }} b JOIN "), own,
        F.lit(" c "), text,
    )
    return table(spark, sf, "documents").select("doc_id", X.restore_refs(original, generated).alias("body"))


@query(
    "text_lower_sources",
    """
    SELECT doc_id, text || ' {{ source(''bronze'', "' || lower(source) || '") }} {{source( ''' || lower(lang)
        || ''' , ''orders'' )}} {{ ref(''KEPT'') }} ' || text AS body FROM documents
    """,
)
def text_lower_sources(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    generated = F.concat(
        text, F.lit(" {{ source('BRONZE', \""), F.upper("source"), F.lit("\") }} {{source( '"), F.upper("lang"),
        F.lit("' , 'Orders' )}} {{ ref('KEPT') }} "), text,
    )
    return table(spark, sf, "documents").select("doc_id", X.lower_sources(generated).alias("body"))


@query(
    "text_compile",
    f"""
    SELECT doc_id, {_stripped("'SELECT ' || text || ' FROM DEV.BRONZE.' || upper(source) || ' a JOIN DEV.SILVER.' || upper(lang) || ' b JOIN DEV.CONFIG.T ' || text")} AS body
    FROM documents
    """,
)
def text_compile(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    model = F.concat(
        F.lit("{{\n  config(database = var('db_name'),\n schema = 'SILVER')\n}}\n\nSELECT "), text,
        F.lit(" FROM {{ source('bronze', '"), F.col("source"), F.lit("') }} a JOIN {{ref( \""), F.col("lang"),
        F.lit("\" )}} b JOIN {{ var('db_name') }}.CONFIG.T "), text,
    )
    return table(spark, sf, "documents").select("doc_id", X.compile_model(model, "DEV").alias("body"))
