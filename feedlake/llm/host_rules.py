"""Quality rules with host verdicts: rule failures by host, shrunk with an empirical beta prior, joined back to documents.

Per document: words are runs of characters other than space and tab to carriage return; a document fails the base
rules with fewer than 10 words, or when more than 20 % of its words lie in a 5-word window that occurs twice or more
in the document. Per host (the `source` column; null is a host of its own): n documents, f failures. A beta prior over hosts is fitted by
the method of moments; a host is rejected when the lower bound of its posterior failure rate (mean - z sd) is over
`max_rate`. A host of few documents stays near the prior, so only clear evidence rejects one, and its documents that
passed the rules then go too.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from feedlake.llm.rows import map_texts, quoted
from feedlake.workspace import materialize

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Fixed value: characters counted as symbols.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list) -> int:
    """Words inside WINDOW-word windows found twice or more, exactly: window numbers are built by ranking pairs."""
    n = len(words)
    if n <= WINDOW:
        return 0
    number: dict = {}
    code = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    window, size = code, len(number)
    for k in range(1, WINDOW):  # numbers of (k + 1)-word windows
        window = window[:-1] * len(number) + code[k:]
        if k < WINDOW - 1 and size > (1 << 62) // len(number) ** 2:
            _, window = np.unique(window, return_inverse=True)
            size = n
        else:
            size *= len(number)
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(window), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()  # bytes split at exactly these six characters
    seen: set[str] = set()
    dup = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                dup += 1
            elif line and line.strip(SPACES):
                seen.add(line)
    chars = len(text) - sum(map(text.count, SPACES))
    return len(words), chars, sum(map(text.count, SYMBOLS)), dup, repeated_words(words)


def beta_prior(k: int, total: float, failed: float, square: float, sizes: float, least: float) -> tuple[float, float]:
    """(a, b) from k hosts: documents, failures, sum of failed**2 / n and of n**2. Hosts that agree give strength 1000; no
    failures or nothing but failures give the rate of half a failure."""
    if not total:
        return least / 2, least / 2
    m = min(max(failed, 0.5), total - 0.5) / total
    # the scatter sum of n (rate - m)**2 is m (1 - m) (k - 1 + rho (total - sizes / total - k + 1)) in expectation
    spare = total - sizes / total - k + 1
    rho = (max(0.0, square - failed * failed / total) / (m * (1 - m)) - (k - 1)) / spare if k > 1 and spare > 0 else 0.0
    strength = max(least, min(1000.0, 1 / rho - 1)) if rho > 0 else 1000.0
    return m * strength, (1 - m) * strength


def host_verdicts(failures: DataFrame, max_rate: float = 0.5, z: float = 2.0, min_strength: float = 2.0) -> DataFrame:
    """host, n, failed -> with rate (posterior mean), low (its lower bound) and host_rejected.

    The prior is Beta(m s, (1 - m) s): m the failure rate over all documents, s from the variance of the hosts' rates
    beyond what sampling gives, between `min_strength` and 1000. One row of statistics goes through the driver.
    """
    stats = failures.agg(
        F.sum("n").cast("double").alias("t"),
        F.sum("failed").cast("double").alias("f"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("failed").cast("double") * F.col("failed") / F.col("n")).alias("q"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
    ).first()
    a, b = beta_prior(stats["k"], stats["t"] or 0.0, stats["f"] or 0.0, stats["q"] or 0.0, stats["nn"] or 0.0, min_strength)
    a, b = F.lit(a) + F.col("failed"), F.lit(b) + F.col("n") - F.col("failed")
    out = failures.withColumn("rate", a / (a + b))
    out = out.withColumn("low", F.col("rate") - z * F.sqrt(a * b / (a + b + 1)) / (a + b))
    return out.withColumn("host_rejected", F.col("low") > max_rate)


def quality_rules(
    docs: DataFrame, keep=("doc_id",), host: str = "source", text: str = "text", max_rate: float = 0.5, z: float = 2.0
) -> DataFrame:
    """`keep` columns, the counts, base_failed, host_rate, host_rejected and kept, one row per document row.

    Null and empty texts count zero words and fail. Repeated rows are judged alike, a null host is a host, other columns
    are ignored, an empty table gives no rows. The counts are written once to the shared folder; failures combine
    map-side, so a host with a third of all rows costs one row a task; the verdicts come back by a join that Spark
    broadcasts when small and otherwise splits at hot hosts.
    """
    own = [c for c in dict.fromkeys([*keep]) if c != "__host"]
    named = docs.withColumn("__host", F.col(quoted(host)).cast("string"))
    fields = [StructField(c, LongType()) for c in COUNTS]
    measured = map_texts(named, [*own, "__host"], text, lambda: lambda texts: list(zip(*map(measure, texts))) or [[]] * 5, fields)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = materialize(measured.withColumn("base_failed", failed), "quality-counts")
    by_host = judged.groupBy("__host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("int")).alias("failed"))
    by_host = materialize(by_host, "quality-failures")
    verdicts = host_verdicts(by_host, max_rate, z).select(F.col("__host").alias("__of"), F.col("rate").alias("host_rate"), "host_rejected")
    verdicts = materialize(verdicts, "quality-hosts")
    out = judged.join(verdicts, F.col("__host").eqNullSafe(F.col("__of")), "left").drop("__host", "__of")
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
