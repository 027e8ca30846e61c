"""Mix sources to target weights with hash-threshold histograms.

Every document has a 60-bit hash. A source takes the documents whose hash lies
below its threshold, so applying a mix is a filter: no sort, no shuffle of texts.
The thresholds come from nested histograms: words are summed by source and by the
hash's first ten bits, the bucket in which a source's budget runs out is found, and
only the rows of that bucket are summed again by the next ten bits, until a bucket
holds a single hash value. Budgets above a source's size take whole copies first
and the threshold for what is left. A document at the threshold gives the words that
are missing, so that a source ends within a word of its target per such document.

Defined cases: a null or empty text has size 0 and takes 0 words; a null source is a
source of its own, ordered last; rows equal in id and text have one hash and share the
words at a threshold evenly; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streakline.functions.ordered import number_all
from streakline.functions.sizing import broadcast_if_small
from streakline.session import stage

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, STEP_BITS = 60, 10


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def mix_hash(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of an MD5 of id and text."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def sized(docs: DataFrame) -> DataFrame:
    """Id, source, size and hash of each document; no texts."""
    return docs.select(
        F.col("doc_id"),
        F.col("source"),
        word_count(F.col("text")).alias("size"),
        mix_hash(F.col("doc_id"), F.col("text")).alias("h"),
    )


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    Weights repeat over the sources in code-point order. The targets share the sum of
    all sizes; one above ``cap`` times its source is held there and the excess goes to
    the others by weight, until none is above. Only sums reach the driver.
    """
    found = stage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    ranked = number_all(found.withColumn("no_source", F.col("source").isNull()), ["no_source", "source"], "place", 0)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stage(ranked.select("source", "source_size", weight.cast("bigint").alias("weight")))
    limit = F.col("source_size") * F.lit(cap)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, held = 0.0, -1
    while True:
        above = F.lit(held >= 0) & (limit < F.lit(level) * F.col("weight"))
        at_cap, free, count = sources.agg(
            F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)
        ).first()
        if count == held or not free:
            break
        level, held = (total - (at_cap or 0)) / free, count
    target = F.least(limit.cast("double"), F.lit(level) * F.col("weight"))
    return stage(sources.select("source", "source_size", target.alias("target")))


def _boundary(rows: DataFrame, budgets: DataFrame, bits: int) -> DataFrame:
    """The bucket of ``bits`` leading bits in which each source's budget runs out.

    ``budgets`` has ``source, budget`` and ``before``, the words below the rows given.
    """
    bucket = F.shiftright("h", HASH_BITS - bits)
    sums = rows.groupBy("source", bucket.alias("bucket")).agg(
        F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high")
    )
    # At most 2 ** STEP_BITS rows per source: one bucket of the level above was split.
    below = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    running = sums.withColumn("below", F.coalesce(F.sum("words").over(below), F.lit(0)))
    named = budgets.withColumnRenamed("source", "of")
    return (
        running.join(named, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("below", F.col("before") + F.col("below"))
        .where((F.col("below") < F.col("budget")) & (F.col("below") + F.col("words") >= F.col("budget")))
        .select("source", "budget", "bucket", "low", "high", F.col("below").alias("before"), "words")
    )


def mix_plan(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """One row per source: ``source, source_size, target, copies, cut, part, tied``.

    A document is taken ``copies`` times, once more if its hash is below ``cut``, and
    those at ``cut``, ``tied`` words in all, give ``part`` words together.
    """
    targets = source_targets(sizes, weights, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.round(F.col("target") - F.col("copies") * F.col("source_size")).cast("bigint")
    plan = targets.withColumn("copies", whole.cast("int")).withColumn("budget", rest)
    budgets = plan.where("budget > 0").select("source", "budget", F.lit(0).cast("bigint").alias("before"))
    rows, done, bits = sizes.where("size > 0").select("source", "size", "h"), None, STEP_BITS
    while True:
        found = stage(_boundary(rows, broadcast_if_small(budgets), bits))
        settled = found.where("low = high")
        done = settled if done is None else done.unionByName(settled)
        open_ = found.where("low < high")
        if open_.isEmpty():
            break
        # Only the rows of the boundary buckets go on to the next level.
        budgets = open_.select("source", "budget", "before")
        edges = broadcast_if_small(open_.select(F.col("source").alias("of"), "bucket"))
        inside = F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("h", HASH_BITS - bits) == F.col("bucket"))
        rows = rows.join(edges, inside).select("source", "size", "h")
        bits += STEP_BITS
    cuts = done.select(
        F.col("source").alias("of"),
        F.col("low").alias("cut"),
        (F.col("budget") - F.col("before")).alias("part"),
        F.col("words").alias("tied"),
    )
    joined = plan.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left")
    return stage(joined.select("source", "source_size", "target", "copies", "cut", "part", "tied"))


def with_shares(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with source, size, h) with ``full``, the whole copies, and ``part``, further words."""
    named = plan.withColumnsRenamed({c: f"mix_{c}" for c in plan.columns})
    joined = rows.join(broadcast_if_small(named), F.col("source").eqNullSafe(F.col("mix_source")))
    below = F.coalesce((F.col("h") < F.col("mix_cut")).cast("int"), F.lit(0))
    at = F.when(F.col("h") == F.col("mix_cut"), F.floor(F.col("mix_part") * F.col("size") / F.col("mix_tied")))
    part = F.coalesce(at.cast("bigint"), F.lit(0))
    # A part as large as the document is one more copy.
    one_more = ((part == F.col("size")) & (part > 0)).cast("int")
    return joined.select(
        *[F.col(c) for c in rows.columns],
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_copies") + below + one_more).alias("full"),
        F.when(one_more == 1, 0).otherwise(part).cast("bigint").alias("part"),
    )


def mix_sizes(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """What the mix takes of each document: ``doc_id, size, source_size, target, taken``."""
    sizes = stage(sized(docs))
    shares = with_shares(sizes, mix_plan(sizes, weights, cap))
    taken = F.col("full") * F.col("size") + F.col("part")
    return shares.select("doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"))


def mix_documents(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """The mixed table, columns of ``docs``: a document comes as often as it is taken, whole each time.

    The document at a source's threshold comes once more if half of it or more is due.
    """
    plan = mix_plan(stage(sized(docs)), weights, cap)
    inner = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(
        inner,
        F.col("source"),
        word_count(F.col("text")).alias("size"),
        mix_hash(F.col("doc_id"), F.col("text")).alias("h"),
    )
    shares = with_shares(rows, plan)
    due = ((F.col("part") > 0) & (2 * F.col("part") >= F.col("size"))).cast("int")
    copies = F.array_repeat(F.lit(0), (F.col("full") + due).cast("int"))
    return shares.select("row", F.explode(copies)).select("row.*")


SQL = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS h
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
    FROM sized GROUP BY source
), filled AS (
    SELECT *, coalesce(sum(3 * source_size) OVER below, 0) AS held, coalesce(sum(weight) OVER below, 0) AS gone,
           sum(weight) OVER () AS weights, sum(source_size) OVER () AS total
    FROM sources WINDOW below AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
    SELECT arg_min((total - held)::DOUBLE / (weights - gone)::DOUBLE, gone) AS level FROM filled
    WHERE (total - held)::DOUBLE / (weights - gone)::DOUBLE * weight <= 3 * source_size
), targets AS (
    SELECT source, source_size, least((3 * source_size)::DOUBLE, coalesce(level, 0) * weight) AS target FROM sources, levels
), plan AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM targets
), ordered AS (
    SELECT d.*, p.source_size, p.target, p.copies, round(p.target - p.copies * p.source_size)::BIGINT AS budget,
           sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto, sum(size) OVER (PARTITION BY d.source, h) AS tied
    FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (copies * size + CASE WHEN budget <= 0 OR size = 0 THEN 0 WHEN upto <= budget THEN size
            WHEN upto - tied < budget THEN floor((budget - (upto - tied)) * size / tied) ELSE 0 END)::BIGINT AS taken
FROM ordered
"""
