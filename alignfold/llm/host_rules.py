"""Host-level quality rules: failures by host, rates shrunk by an empirical beta prior, verdicts joined back."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alignfold.llm.common import label_key, prepared, salted_join, slices, stage

SYMBOLS = b"#*$%&|<>"
#: Rule -> SQL over the counted columns that is true where a document fails it.
RULES = {
    "base": "n_words < 50 OR 100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 3 * n_words OR word_chars > 12 * n_words",
}
#: A host goes when the shrunk share of its documents that fail one rule is over this.
HOST_LIMIT = 0.5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def count_text(text: str) -> tuple[int, ...]:
    """The numbers named in COUNTS, of one text."""
    raw = text.encode()
    words = raw.split()  # bytes split at the ASCII white space that bounds words here
    word_chars = len(text) - (len(raw) - sum(map(len, words)))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split()] if b"\n" in raw else words[:1]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        reach = 0  # words before this place are counted
        for i, window in enumerate(windows):
            if times[window] > 1:
                repeated += i + 3 - max(i, reach)
                reach = i + 3
    return len(words), word_chars, n_symbols, len(lines), len(lines) - len(set(lines)), repeated


def count_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                carry: tuple[str, ...] = ()) -> DataFrame:
    """Id, host, carried columns, the counts of COUNTS and ``failed`` (array of the rules a document fails)."""
    prepared(df.sparkSession)
    keep = [F.col(id_col).alias("id"), F.col(host_col).alias("host"), *[F.col(c) for c in carry]]
    rows = df.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("whole"))
    kept = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [count_text(t) for t in batch.column("whole").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], *[pa.array(x, pa.int64()) for x in zip(*found)]],
                [*kept, *COUNTS])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    counted = rows.mapInArrow(run, types + "".join(f", {c} long" for c in COUNTS))
    failed = F.filter(F.array(*[F.expr(f"CASE WHEN {rule} THEN '{name}' END") for name, rule in RULES.items()]),
                      lambda x: x.isNotNull())
    return counted.withColumn("failed", failed)


def host_verdicts(counted: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """A row per host and rule: documents ``n``, failures ``f``, ``shrunk`` rate and ``bad`` (over the limit).

    The prior of a rule is the beta distribution whose mean is the rule's overall rate and whose
    variance is that of the hosts' rates less what chance alone gives (moments over all hosts). A
    host of few documents is drawn to the mean, one of many keeps its own rate. Documents without
    a host make no host. One aggregate by host; only the prior's few numbers reach the driver.
    """
    hosts = counted.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.array_contains("failed", name).cast("long")).alias(name) for name in RULES])
    sums = [F.sum("n").alias("docs"), F.count(F.lit(1)).alias("hosts"), F.sum(1 / F.col("n")).alias("inverse")]
    for name in RULES:
        sums += [F.sum(name).alias(name), F.var_pop(F.col(name) / F.col("n")).alias(f"{name}_var")]
    hosts = stage(hosts, "hosts")
    got = hosts.agg(*sums).first()
    out = []
    for name in RULES:
        mean = (got[name] or 0) / max(got["docs"] or 0, 1)
        spread = mean * (1 - mean)
        between = (got[f"{name}_var"] or 0.0) - spread * (got["inverse"] or 0.0) / max(got["hosts"], 1)
        weight = min(max(spread / between - 1, 1.0), 1e6) if between > 0 else 1e6  # alpha + beta
        shrunk = (F.col(name) + mean * weight) / (F.col("n") + weight)
        out.append(F.struct(F.lit(name).alias("rule"), F.col(name).alias("f"), shrunk.alias("shrunk"),
                            (shrunk > limit).alias("bad")))
    return hosts.select("host", "n", F.explode(F.array(*out)).alias("r")).select("host", "n", "r.*")


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          carry: tuple[str, ...] = (), limit: float = HOST_LIMIT) -> DataFrame:
    """Counts of every document with ``base_failed``, ``host_bad`` and ``kept``.

    A document is kept if it passes the base rule and its host is good under every rule. A null
    host has no verdict (its documents are judged by the base rule alone); a null or empty text
    has no words and fails the base rule; repeated rows count each; an empty table gives none.
    """
    counted = stage(count_rules(df, id_col, text_col, host_col, carry), "rule-counts")
    bad = host_verdicts(counted, limit).groupBy("host").agg(F.max("bad").alias("host_bad"))
    verdicts = stage(bad.select(label_key("host").alias("_host"), "host_bad").unionByName(
        df.sparkSession.createDataFrame([("n", False)], "_host string, host_bad boolean")), "host-verdicts")
    rows = counted.withColumn("_host", label_key("host"))
    judged = salted_join(rows, verdicts, "_host", F.col("id")).drop("_host")
    base = F.array_contains("failed", "base")
    return judged.withColumn("base_failed", base).withColumn("kept", ~base & ~F.col("host_bad")) \
        .withColumnRenamed("id", id_col).withColumnRenamed("host", host_col)
