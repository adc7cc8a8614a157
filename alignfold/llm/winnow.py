"""Winnowed document fingerprints with DataFrame functions only.

The text's k-grams are hashed at every place, and of each window of ``w`` hashes the smallest is
kept (the rightmost of equals). Two texts that share w + k - 1 characters in a row share a
fingerprint, and no match shorter than k characters counts. Long texts are worked block by block,
so that every array stays small and a place in a block is found in constant time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alignfold.llm.common import text_or_empty

GRAM = 16
WINDOW = 32
BLOCK = 224  # GRAM + WINDOW - 2 <= BLOCK, and BLOCK + WINDOW <= 256 (a place in a block takes 8 bits)
#: Hashes keep 55 bits above the place in the block, counted from the right: the least of equals is the rightmost.
HASH_BITS = 0x7FFFFFFFFFFFFF00


def with_minima(df: DataFrame, text: str, out: str) -> DataFrame:
    """``out``: for each block of the text, the kept minima (hash and place packed in a long).

    A text shorter than GRAM makes one gram, one with fewer than WINDOW grams one window, an
    empty one nothing. Grams are hashed in UTF-32, in which a place is found without counting
    characters.
    """
    reach = GRAM + WINDOW - 2
    cut = df.withColumn(out, F.expr(f"regexp_extract_all({text}, '(?s).{{1,{BLOCK}}}', 0)"))
    hashed = cut.withColumn(out, F.expr(f"""transform({out}, (block, i) ->
        transform(array(encode(concat(block, left(coalesce(get({out}, i + 1), ''), {reach})), 'UTF-32')), c ->
            transform(sequence(1, greatest(octet_length(c) div 4 - {GRAM - 1}, 1)), j ->
                (xxhash64(substring(c, 4 * j - 3, {4 * GRAM})) & {HASH_BITS}L) | (256 - j)))[0])"""))
    step = 1
    while step < WINDOW:  # minima over 4, 16, ... WINDOW hashes; past the end, over those that are left
        ahead = range(step, min(4 * step, WINDOW), step)
        hashed = hashed.withColumn(out, F.expr(
            f"transform({out}, a -> transform(a, (x, i) -> least(x, {', '.join(f'get(a, i + {k})' for k in ahead)})))"))
        step *= 4
    return hashed.withColumn(out, F.expr(f"""transform({out}, a -> array_distinct(
        CASE WHEN size(a) >= {WINDOW} THEN slice(a, 1, size(a) - {WINDOW - 1})
             WHEN size({out}) = 1 THEN slice(a, 1, 1)
             ELSE slice(a, 1, 0) END))"""))


def hashes(minima: str) -> Column:
    """The kept hashes of all blocks, in order, each once (31 bits of each)."""
    return F.expr(f"array_distinct(transform(flatten({minima}), m -> cast((m >> 8) & 2147483647L AS int)))")


def likeness(a: str, b: str) -> Column:
    """Shared share of two sets of hashes (Jaccard); two empty sets are alike."""
    return F.expr(f"""CASE WHEN size({a}) + size({b}) = 0 THEN 1.0D
        ELSE cast(size(array_intersect({a}, {b})) AS double) / size(array_union({a}, {b})) END""")


def as_text(hashes_col: str) -> Column:
    return F.expr(f"array_join(transform({hashes_col}, x -> lpad(lower(hex(x)), 8, '0')), '')")


def fingerprint(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with ``prints``: array<struct<hash: long, pos: long>> of the kept grams in order of place.

    A null text counts as empty: no prints. Equal texts have equal prints. Other columns pass; a
    column of df named ``prints`` is replaced.
    """
    found = with_minima(df.withColumn("_whole", text_or_empty(text_col)), "_whole", "_minima")
    flat = found.withColumn("prints", F.expr(f"""flatten(transform(_minima, (block, i) -> transform(block, m ->
        named_struct('hash', m >> 8, 'pos', cast(i AS bigint) * {BLOCK} + 255 - (m & 255)))))"""))
    # places never go back from window to window, so a place kept twice stands next to itself
    once = flat.withColumn("prints", F.expr("filter(prints, (p, i) -> i = 0 OR p.pos <> get(prints, i - 1).pos)"))
    return once.drop("_whole", "_minima")


def neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``n_chars``, ``hashes`` (its own), ``edited`` (the edited text: the last
    quarter of its characters replaced by the first as many of the next document by id),
    ``edited_hashes`` and ``next_hashes`` (the next document's).

    Documents are ordered by (id, hash of the text), null ids first; the last one's next is the
    first. Every row is a document: of rows equal in both, each but the last has its like as next.
    A single document is its own next. A null text is empty.

    The order is cut into buckets at keys of documents, of which the driver holds one a bucket, four
    for each shuffle partition. Text is shuffled once, to its bucket; the first document of each
    bucket also goes to the bucket before, where it is the next of the last.
    """
    spark = df.sparkSession
    whole = text_or_empty(text_col)
    docs = df.select(F.col(id_col).alias("id"), F.xxhash64(whole).alias("h"), whole.alias("whole"))
    key = F.struct("id", "h")
    n_buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = docs.select("id", "h").repartitionByRange(n_buckets, "id", "h")
    firsts = sorted((r["k"] for r in ranges.groupBy(F.spark_partition_id()).agg(F.min(key).alias("k")).collect()),
                    key=lambda k: (k["id"] is not None, k["id"] or 0, k["h"]))
    if not firsts:
        firsts = [{"id": None, "h": 0}]
    step = max(1, int(len(firsts) ** 0.5))  # looked up in two steps: first among every step-th key
    kind = f"struct<id:{docs.schema['id'].dataType.simpleString()},h:bigint>"
    literal = lambda keys: F.array(*[F.struct(F.lit(k["id"]).alias("id"), F.lit(k["h"]).alias("h"))
                                     for k in keys]).cast(f"array<{kind}>")
    placed = docs.withColumn("key", key).withColumn("bounds", literal(firsts)).withColumn("tops", literal(firsts[::step]))
    placed = placed.withColumn("top", F.expr("size(filter(tops, t -> t <= key))")) \
        .withColumn("near", F.expr(f"slice(bounds, greatest(top - 1, 0) * {step} + 1, {step})")) \
        .withColumn("bucket", F.expr(f"greatest(top - 1, 0) * {step} + size(filter(near, t -> t <= key)) - 1"))
    opens = F.col("key").eqNullSafe(F.get("bounds", F.col("bucket")))
    own = F.struct("bucket", F.lit(False).alias("guest"))
    guest = F.struct(F.pmod(F.col("bucket") - 1, F.lit(len(firsts))).alias("bucket"), F.lit(True).alias("guest"))
    rows = placed.withColumn("to", F.explode(F.when(opens, F.array(own, guest)).otherwise(F.array(own)))) \
        .select("to.*", "id", "h", "whole").repartition("bucket")
    found = with_minima(rows, "whole", "minima").withColumn("n", F.char_length("whole").cast("long")) \
        .withColumn("kept", F.expr("n - n div 4"))
    # blocks whose windows all lie in the characters that stay have the same minima in the edited text
    safe = F.expr(f"cast(greatest(kept - {GRAM + WINDOW - 1}, 0) div {BLOCK} AS int)")
    found = found.withColumn("safe", safe).withColumn("hashes", hashes("minima")) \
        .withColumn("n_head", F.size(hashes("slice(minima, 1, safe)"))).drop("minima")
    order = Window.partitionBy("bucket").orderBy("guest", F.col("id").asc_nulls_first(), "h")
    met = found.withColumn("next", F.lead(F.struct("whole", "hashes")).over(order)).filter(~F.col("guest"))
    edited = met.withColumn("edited", F.expr("concat(left(whole, kept), left(next.whole, n - kept))"))
    # the part of the edited text that starts at its first changed block
    tail = with_minima(edited.withColumn("tail", F.expr(f"substring(edited, safe * {BLOCK} + 1)")), "tail", "minima")
    done = tail.withColumn("edited_hashes", F.array_distinct(F.concat(
        F.expr("slice(hashes, 1, n_head)"), hashes("minima"))))
    return done.select(F.col("id").alias(id_col), F.col("n").alias("n_chars"), "hashes", "edited", "edited_hashes",
                       F.col("next.hashes").alias("next_hashes"))
