"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences.

A blank line ends a section and a line end a paragraph; a paragraph's leaves are its sentences, cut after `.`, `!` or `?`
or, where none comes, after 96 characters. A paragraph's digest covers its leaves' digests, a section's those of its
paragraphs, and the root those of the sections: equal roots mean equal texts. Two texts are as like as the share of leaves
they have in common, and going down from the root along differing branches finds the edited paragraphs.

Defined cases: a null text is empty; an empty text has one section with one paragraph without leaves, and is fully like
itself; repeated leaves count once in a likeness; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAF = r"[^.!?]{1,96}[.!?]*|[.!?]+"
# Documents of a slice, and bounds of the number of slices: beyond 65 million documents the slices grow instead.
SLICE_ROWS, LEAST_SLICES, MOST_SLICES = 1000, 256, 65_536


def leaf_texts(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(LEAF), F.lit(0))


def leaves(text: Column) -> Column:
    """Short hashes of all leaves of a text, for likeness alone."""
    return F.transform(leaf_texts(text), lambda leaf: F.substring(F.md5(leaf), 1, 16))


def paragraph_digests(section: Column) -> Column:
    """Digest of each paragraph of a section, over the full digests of its leaves."""
    digests = lambda p: F.transform(leaf_texts(p), lambda leaf: F.sha2(leaf, 256))
    return F.transform(F.split(section, "\n"), lambda p: F.sha2(F.array_join(digests(p), ","), 256))


def tree(text: Column) -> Column:
    """The tree as an array of sections, each an array of paragraph digests."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n"), paragraph_digests)


def section_digests(of: Column) -> Column:
    return F.transform(of, lambda paragraphs: F.sha2(F.array_join(paragraphs, ","), 256))


def root(of: Column) -> Column:
    """Root digest of a tree."""
    return F.sha2(F.array_join(section_digests(of), ","), 256)


def leaf_set(text: Column) -> Column:
    """The distinct leaves of a whole text."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.array_distinct(F.flatten(F.transform(lines, leaves)))


def likeness(left: Column, right: Column) -> Column:
    """Share of common leaves of two leaf sets, 0 to 1; two empty sets are alike."""
    total = F.size(left) + F.size(right)
    return F.when(total == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(left, right)) / total)


def edits(left: Column, right: Column) -> Column:
    """Where two trees differ: an array of (section, paragraph), from 0, found by descending only differing branches."""
    none = F.array().cast("array<string>")
    at = lambda t, i: F.coalesce(F.get(t, i), none)

    def inside(a: Column, b: Column, i: Column) -> Column:
        last = F.greatest(F.size(a), F.size(b)) - 1
        positions = F.filter(F.sequence(F.lit(0), last), lambda j: ~F.get(a, j).eqNullSafe(F.get(b, j)))
        return F.transform(positions, lambda j: F.struct(i.alias("section"), j.alias("paragraph")))

    last = F.greatest(F.size(left), F.size(right)) - 1
    differing = F.filter(F.sequence(F.lit(0), last), lambda i: ~F.get(left, i).eqNullSafe(F.get(right, i)))
    return F.flatten(F.transform(differing, lambda i: inside(at(left, i), at(right, i), i)))


def _position(cuts: list, of: Column, kind: str) -> Column:
    """How many of the ascending cuts are at or below a value: first among every n-th cut, then inside one stretch."""
    step = max(1, int(len(cuts) ** 0.5))
    listed = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")
    at_most = lambda values: F.size(F.filter(values, lambda c: c <= of))
    stretch = at_most(listed(cuts[::step])) - 1
    inside = at_most(F.slice(listed(cuts), stretch * step + 1, F.lit(step)))
    return F.when(of.isNull() | (of < F.lit(cuts[0]).cast(kind)), 0).otherwise(stretch * step + inside)


def with_next(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """`doc_id`, `text` and `next_text`, the text of the next document by id; after the last comes the first.

    The ids are cut into slices at quantiles, about `slice_rows` documents each; a slice also receives the first document
    of the next one, so each successor is found inside its slice and no task orders the whole table. Ids are whole numbers;
    null ids come first; equal ids go by text.
    """
    plain = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = plain.count()
    slices = min(MOST_SLICES, max(LEAST_SLICES, rows // slice_rows))
    found = plain.agg(
        F.min("doc_id").alias("low"),
        F.max(F.col("doc_id").isNull()).alias("nulls"),
        F.percentile_approx("doc_id", [i / slices for i in range(1, slices)], 10 * slices).alias("cuts"),
    ).first()
    cuts = sorted({c for c in (found["cuts"] or []) if c > found["low"]})
    own = _position(cuts, F.col("doc_id"), kind) if cuts else F.lit(0)
    # a slice begins at a cut, which is an id: that document is also a guest at the end of the slice before
    begins = F.lit(False)
    if cuts:
        at_cut = F.split(F.lit(",".join(map(str, cuts))), ",").cast(f"array<{kind}>")
        begins = F.coalesce(F.get(at_cut, F.col("_own") - 1) == F.col("doc_id"), F.lit(False))
    first = F.col("doc_id").isNull() if found["nulls"] else F.col("doc_id") == F.lit(found["low"])
    place = lambda number, guest: F.struct(number.alias("slice"), F.lit(guest).alias("guest"))
    places = F.array_compact(
        F.array(
            place(F.col("_own"), False),
            F.when(begins, place(F.col("_own") - 1, True)),
            F.when(first, place(F.lit(len(cuts)), True)),
        )
    )
    placed = plain.withColumn("_own", own).select("doc_id", "text", F.inline(places))
    # the very first document closes the last slice, behind any other guest
    order = Window.partitionBy("slice").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    return placed.withColumn("next_text", F.lead("text").over(order)).filter(~F.col("guest")).drop("slice", "guest")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Query of the operator: each document against an edited copy and against the next document."""
    n = F.length("text").cast("bigint")
    paired = with_next(docs).withColumn("n_chars", n)
    moved = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - moved),
        F.substring(F.col("next_text"), F.lit(1), moved),
    )
    grown = paired.withColumn("edited", edited).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        root(tree(F.col("text"))).alias("fingerprint"),
        root(tree(F.col("edited"))).alias("edited_fingerprint"),
        leaf_set(F.col("text")).alias("_own"),
        leaf_set(F.col("edited")).alias("_edited"),
        leaf_set(F.col("next_text")).alias("_next"),
    )
    return grown.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("_own"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"),
    )


def _leaves_sql(p: str, of: str = "substr(md5(l), 1, 16)") -> str:
    return f"list_transform(regexp_extract_all({p}, '{LEAF}'), lambda l: {of})"


def _root_sql(text: str) -> str:
    paragraphs = f"list_transform(string_split(s, chr(10)), lambda p: sha256(array_to_string({_leaves_sql('p', 'sha256(l)')}, ',')))"
    sections = f"list_transform(string_split({text}, chr(10) || chr(10)), lambda s: sha256(array_to_string({paragraphs}, ',')))"
    return f"sha256(array_to_string({sections}, ','))"


def _set_sql(text: str) -> str:
    return f"list_distinct(flatten(list_transform(string_split({text}, chr(10)), lambda p: {_leaves_sql('p')})))"


def _like_sql(a: str, b: str) -> str:
    return (
        f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE"
        f" ELSE 2.0::DOUBLE * len(list_intersect({a}, {b})) / (len({a}) + len({b})) END"
    )


SQL = f"""
WITH paired AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS next_text
  FROM documents WINDOW w AS (ORDER BY doc_id NULLS FIRST, coalesce(text, ''))),
made AS (
  SELECT *, left(text, (length(text) - length(text) // 4)::INT) || left(next_text, (length(text) // 4)::INT) AS edited FROM paired),
grown AS (
  SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, {_root_sql("text")} AS fingerprint,
         {_root_sql("edited")} AS edited_fingerprint, {_set_sql("text")} AS own, {_set_sql("edited")} AS other,
         {_set_sql("next_text")} AS following
  FROM made)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
       {_like_sql("own", "other")} AS near_edited, {_like_sql("own", "following")} AS near_next
FROM grown"""
