"""Document fingerprints as Merkle trees, built from SQL functions only.

A text is cut into lines (paragraphs), each line into short leaves that start anew behind the end of a
sentence. A paragraph's digest is taken over the digests of its leaves, a section is a run of paragraphs that
ends where a paragraph's digest says so, and the root is taken over the sections. An edit changes the
leaves it touches and the branches above them; all other branches keep their digests, also when
text before them grows or shrinks. The fingerprint spells the tree: ``root/section(paragraph:leafleaf...;...)...``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import texts

#: Code points in a leaf at most, and hexadecimal digits of the digests of leaves and branches.
LEAF, LEAF_DIGITS, BRANCH_DIGITS = 20, 6, 12
#: One paragraph in so many ends a section.
SECTION = 4


def _digest(value: Column, digits: int) -> Column:
    return F.substring(F.sha2(value.cast("binary"), 256), 1, digits)


def _leaf_digest(value: Column) -> Column:
    return F.lower(F.lpad(F.substring(F.hex(F.xxhash64(value)), -LEAF_DIGITS, LEAF_DIGITS), LEAF_DIGITS, "0"))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; null counts as empty. Equal texts have equal fingerprints, and the root
    is the SHA-256 of the whole text together with its tree, so different texts have different ones."""
    text = F.coalesce(text, F.lit(""))
    pattern = F.lit(rf"(?s)[^.!?]{{1,{LEAF}}}[.!?]?|[.!?]")
    leaves = lambda line: F.transform(F.regexp_extract_all(line, pattern, F.lit(0)), _leaf_digest)
    paragraphs = F.transform(F.split(text, "\n"), lambda line: F.array_join(leaves(line), ""))
    ends = lambda p: F.when(F.pmod(F.xxhash64(p), F.lit(SECTION)) == 0, F.lit(")")).otherwise(F.lit(";"))
    listed = F.transform(paragraphs, lambda p: F.concat(_digest(p, BRANCH_DIGITS), F.lit(":"), p, ends(p)))
    sections = F.split(F.array_join(listed, ""), r"\)")
    branches = F.array_join(F.transform(sections, lambda s: F.concat(_digest(s, BRANCH_DIGITS), F.lit("("), s)), ")")
    return F.concat(F.sha2(F.concat(F.sha2(text.cast("binary"), 256), branches).cast("binary"), 256), F.lit("/"), branches)


def leaf_set(tree: Column) -> Column:
    """The distinct leaf digests of a fingerprint."""
    branch = f"[0-9a-f]{{{BRANCH_DIGITS}}}"
    plain = F.regexp_replace(tree, f"^[0-9a-f]{{64}}/|{branch}\\(|{branch}:|[;)]", "")
    return F.array_distinct(F.regexp_extract_all(plain, F.lit(f".{{{LEAF_DIGITS}}}"), F.lit(0)))


def likeness(one: Column, leaves_one: Column, other: Column, leaves_other: Column) -> Column:
    """Shared leaves as a part of the larger set; 1 for equal roots, below 1 for different ones."""
    larger = F.greatest(F.size(leaves_one), F.size(leaves_other))
    share = F.size(F.array_intersect(leaves_one, leaves_other)) / F.greatest(larger, F.lit(1))
    return F.when(one == other, F.lit(1.0)).otherwise(F.least(share, F.lit(0.999)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) for every row; null texts count as empty, repeated rows stay."""
    rows = texts(docs, id_col, text_col)
    return rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), fingerprint(F.col("text")).alias("fingerprint"))


def _blocks(rows: DataFrame, key: str, count: int) -> Column:
    """The block of a row: how many of the key's quantiles lie at or below it. Binary search in a literal array
    whose size depends on ``count`` alone."""
    points = [i / count for i in range(1, count)]
    bounds = rows.agg(F.percentile_approx(key, points, 10 * count)).first()[0] if points else None
    bounds = sorted(set(bounds or []))
    if not bounds:
        return F.lit(0)
    array = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])

    def halve(at: Column, step: Column) -> Column:
        inside = at + step <= len(bounds)
        reached = F.get(array, at + step - 1) <= F.col(key)
        return at + F.when(inside & F.coalesce(reached, F.lit(False)), step).otherwise(0)

    return F.aggregate(steps, F.lit(0), halve)


def with_next(rows: DataFrame, blocks: int) -> DataFrame:
    """Every (doc_id, text) with the text that follows by descending doc_id; the first follows the last.

    Null ids come last; equal ids follow each other by a hash of their texts. The ids are cut into ``blocks``
    blocks by their quantiles. Each block is sorted by itself, after the first row of the block below it
    has been added to its end, so that no order of the whole table is needed.
    """
    key = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key")
    keyed = rows.select("doc_id", "text", key, F.xxhash64("text").alias("tie"))
    block = _blocks(keyed, "key", blocks)
    keyed = keyed.withColumn("block", block)
    tops = keyed.groupBy("block").agg(F.max(F.struct("key", "tie")).alias("top"))
    below = Window.orderBy("block")  # one row a block
    lowest = F.first("block").over(below.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    highest = F.last("block").over(below.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # The first row of a block ends the block above it; that of the highest block ends the lowest.
    ends = tops.select(
        F.when(F.col("block") == highest, lowest).otherwise(F.lead("block").over(below)).alias("above"),
        "block", F.col("top.key").alias("key"), F.col("top.tie").alias("tie"),
    )
    ghosts = keyed.join(F.broadcast(ends), ["block", "key", "tie"]).dropDuplicates(["above"])
    everything = keyed.select("doc_id", "text", "key", "tie", "block", F.lit(False).alias("ghost")).unionByName(
        ghosts.select("doc_id", "text", "key", "tie", F.col("above").alias("block"), F.lit(True).alias("ghost"))
    )
    order = Window.partitionBy("block").orderBy("ghost", F.desc("key"), F.desc("tie"))
    return (
        everything.withColumn("next_text", F.lead("text").over(order))
        .filter(~F.col("ghost"))
        .select("doc_id", "text", "next_text")
    )


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last third replaced by as many of the next text's first code points, or all of them."""
    count = F.floor(F.length(text) / F.lit(3)).cast("int")
    kept = F.substring(text, F.lit(1), F.length(text) - count)
    return F.concat(kept, F.substring(next_text, F.lit(1), count))


def edit_study(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_block: int = 200
) -> DataFrame:
    """Fingerprints of every text, of an edited copy and their likeness to each other and to the next text.

    Returns, for every row, doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next. A single row follows itself. Null texts count as empty; an empty table gives no rows. Blocks
    have about ``rows_per_block`` rows, up to 4096 blocks; then they grow.
    """
    rows = texts(docs, id_col, text_col)
    blocks = max(1, min(4096, docs.count() // rows_per_block))
    followed = with_next(rows, blocks)
    changed = followed.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    trees = changed.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        fingerprint(F.col("next_text")).alias("next_fingerprint"),
    )
    sets = trees.withColumns(
        {f"{c}_leaves": leaf_set(F.col(c)) for c in ("fingerprint", "edited_fingerprint", "next_fingerprint")}
    )
    near = lambda c: likeness(F.col("fingerprint"), F.col("fingerprint_leaves"), F.col(c), F.col(f"{c}_leaves"))
    return sets.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        near("edited_fingerprint").alias("near_edited"), near("next_fingerprint").alias("near_next"),
    )
