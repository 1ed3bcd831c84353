"""License scan: entire texts, and entire lines, looked up by the digest of their canonical form.

Canonical form: lower case, copyright lines dropped, equivalent spellings written one way, everything but letters and digits
turned into single blanks. Known licences go through the same steps, so a text is a licence exactly if the digests agree;
nothing is compared pairwise. Every line is looked up as well, which finds the notices inside other texts.

The digests are joined, not searched: a known side that was counted and is small is broadcast, a larger one is salted for
lines that very many documents share. Lines of a document never leave its task before they are counted.

Defined cases: a null text is empty; an empty or blank text or line is no licence; repeated rows are scanned each; a licence
id that is null is ignored; an empty table, or no known licence, gives no matches; extra columns are ignored by the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scale import lookup, stage_counted
from .license_digests import STANDARD_NOTICES, WHOLE
from .license_texts import KNOWN

# A line that names the holder or the year of a copyright, or reserves all rights.
COPYRIGHT = r"(?m)^[^a-z\n]*(?:copyright +(?:\(c\)|©|[0-9]{4})|\(c\)|©|all rights reserved)[^\n]*$"
COPYRIGHT_FREE = r"^[^a-z\n]*(?:copyright +(?:\(c\)|©|[0-9]{4})|\(c\)|©|all rights reserved)"
# Equivalent spellings: fixed strings first, then endings.
SPELLINGS = (
    ("licenc", "licens"), ("sub-licens", "sublicens"), ("sub licens", "sublicens"), ("non-commercial", "noncommercial"),
    ("https://", "http://"), ("centre", "center"), ("judgement", "judgment"), ("ledgement", "ledgment"), ("programme", "program"),
    ("whilst", "while"), ("per cent", "percent"), ("copyright owner", "copyright holder"), ("catalogue", "catalog"),
    ("artefact", "artifact"), ("defence", "defense"), ("offence", "offense"),
)
ENDINGS = ((r"([a-z]{3})is((?:e[sd]?|ing|ations?)(?:[ \n]|$))", "iz"), (r"([a-z]{2})our((?:s|ed|ing|able|ite)?(?:[ \n]|$))", "or"))


def _spelled(text: Column) -> Column:
    text = F.lower(text)
    for other, one in SPELLINGS:
        text = F.replace(text, F.lit(other), F.lit(one))
    return text


def _letters(text: Column, keep: str = "") -> Column:
    text = F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}{keep}]+", " ")
    for pattern, ending in ENDINGS:
        text = F.regexp_replace(text, pattern, f"$1{ending}$2")
    return text


def lines(text: Column) -> Column:
    """The canonical lines of a text, without copyright lines and blank ones."""
    plain = _letters(F.regexp_replace(_spelled(F.coalesce(text, F.lit(""))), COPYRIGHT, ""), r"\n")
    return F.filter(F.transform(F.split(plain, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def digest(canonical: Column) -> Column:
    """Digest of a canonical text; null for an empty one."""
    return F.when(canonical != "", F.sha2(canonical, 256))


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, license) of known licences given as (license, text); of two with one digest the first by name."""
    entire = digest(F.array_join(lines(F.col("text")), " "))
    rows = known.select(entire.alias("digest"), "license").filter("digest IS NOT NULL AND license IS NOT NULL")
    return rows.groupBy("digest").agg(F.min("license").alias("license"))


def known_licenses(spark) -> DataFrame:
    """The licences and notices that come with the package as texts."""
    return spark.createDataFrame([*KNOWN, *STANDARD_NOTICES], "license string, text string")


def shipped_digests(spark) -> DataFrame:
    """(digest, license) of the licences that come with the package as digests."""
    return spark.createDataFrame(list(WHOLE), "license string, digest string").select("digest", "license")


def scan(docs: DataFrame, known: DataFrame, digests: DataFrame | None = None) -> DataFrame:
    """Per document: `digest` of the entire text, `license` it is, `line_licenses` (distinct, by name) and `license_lines`.

    Licences are `known` as (license, text), or only by their digests as (digest, license).
    """
    rows = known_digests(known)
    if digests is not None:
        rows = rows.unionByName(digests).groupBy("digest").agg(F.min("license").alias("license"))
    table, count = stage_counted(rows, "licenses")
    marked = docs.select("doc_id", lines(F.col("text")).alias("_lines"), F.monotonically_increasing_id().alias("_row"))
    whole = marked.withColumn("digest", digest(F.array_join("_lines", " ")))
    named = lookup(whole, table, ["digest"], table_rows=count)
    split = named.select("_row", "doc_id", F.col("digest").alias("_whole"), F.col("license").alias("_is"), F.explode_outer("_lines").alias("_line"))
    found = lookup(
        split.select("_row", "doc_id", "_whole", "_is", digest(F.col("_line")).alias("digest")), table, ["digest"], table_rows=count
    )
    # rows of a document are together in its task, so this shuffles one row per document
    return found.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("_whole").alias("digest"),
        F.first("_is").alias("license"),
        F.array_sort(F.collect_set("license")).alias("line_licenses"),
        F.count("license").alias("license_lines"),
    ).drop("_row")


def license_report(docs: DataFrame) -> DataFrame:
    """Query of the operator, with the licences that come with the package."""
    spark = docs.sparkSession
    found = scan(docs, known_licenses(spark), shipped_digests(spark))
    return found.withColumn("line_licenses", F.array_join("line_licenses", ","))


def _lines_sql(text: str) -> str:
    made = f"lower(coalesce({text}, ''))"
    for other, one in SPELLINGS:
        made = f"replace({made}, '{other}', '{one}')"
    kept = f"list_filter(string_split({made}, chr(10)), lambda x: NOT regexp_matches(x, '{COPYRIGHT_FREE}'))"
    line = r"regexp_replace(x, '[^\p{L}\p{N}]+', ' ', 'g')"
    for pattern, ending in ENDINGS:
        line = f"regexp_replace({line}, '{pattern}', '\\1{ending}\\2', 'g')"
    line = f"trim({line})"
    return f"list_filter(list_transform({kept}, lambda x: {line}), lambda x: x <> '')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_VALUES = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in [*KNOWN, *STANDARD_NOTICES])
_DIGESTS = ", ".join(f"({_quoted(name)}, {_quoted(known)})" for name, known in WHOLE)
SQL = f"""
WITH known AS (
  SELECT digest, min(license) AS license FROM (
    SELECT sha256(array_to_string({_lines_sql("text")}, ' ')) AS digest, license FROM (VALUES {_VALUES}) AS k(license, text)
    UNION ALL SELECT digest, license FROM (VALUES {_DIGESTS}) AS d(license, digest)) GROUP BY digest),
plain AS (SELECT row_number() OVER () AS row, doc_id, {_lines_sql("text")} AS lines FROM documents),
whole AS (
  SELECT row, doc_id, lines, CASE WHEN len(lines) > 0 THEN sha256(array_to_string(lines, ' ')) END AS digest FROM plain),
matched AS (
  SELECT row, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses, count(*) AS license_lines
  FROM (SELECT row, sha256(unnest(lines)) AS digest FROM plain) JOIN known USING (digest) GROUP BY row)
SELECT doc_id, whole.digest, license, coalesce(line_licenses, '') AS line_licenses, coalesce(license_lines, 0)::BIGINT AS license_lines
FROM whole LEFT JOIN known USING (digest) LEFT JOIN matched USING (row)"""
