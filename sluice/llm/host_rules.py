"""Quality rules by host.

Each document is measured and tested against a few rules. The failures of each rule are counted by host, and a host's rate
is shrunk towards the rate of all hosts by a beta prior fitted to the hosts (empirical Bayes, by moments), so that a host of few
documents is not judged by chance. A host is rejected if the shrunk rate of any rule is over `HOST_LIMIT`, and with it all
its documents; the verdicts are joined back to the documents.

A document is dropped if it fails a base rule or its host is rejected. A null host is no host and is never rejected. Null and
empty texts have no words, fail the rule on short texts and count for their host. Words are runs of `[^\\x20\\x09-\\x0D]`.
Repeated rows count each time, an empty table gives an empty result, extra columns stay. A very long text is held as a whole in one
task, with a number of 8 bytes for each word a few times over.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import BLANKS, bounded_batches, stored, whole_row

HOST_LIMIT, SIGNS, WINDOW = 0.5, "#*$%&|<>", 5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Rules that a document must pass itself, in SQL over the measures; true is a failure.
BASE_RULES = {"short": "n_words < 10", "repeats": "100 * n_repeat_words > 20 * n_words"}
#: Rules whose failures count for the host.
HOST_RULES = BASE_RULES | {
    "symbols": "100 * n_symbols > 10 * word_chars",
    "long_words": "word_chars > 12 * n_words",
    "dup_lines": "20 * n_dup_lines > n_words",
}
#: Bounds of the prior's weight, in documents.
LEAST_PRIOR, MOST_PRIOR = 1.0, 1e6


def measured(text: str | None) -> tuple[int, ...]:
    """The values of `MEASURES`."""
    text = text or ""
    words = text.encode(errors="surrogatepass").split()
    chars = len(text) - sum(map(text.count, BLANKS)) if words else 0
    lines = Counter(x for x in text.split("\n") if x.strip(BLANKS))
    return len(words), chars, sum(map(text.count, SIGNS)), lines.total() - len(lines), _repeated(words)


def _repeated(words: list[bytes]) -> int:
    """Words that are in a window of `WINDOW` words that the text has more than once."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    kind = codes[:n]  # of the window so far: equal windows are of one kind
    for k in range(1, WINDOW):
        kind = np.unique(kind * len(number) + codes[k : k + n], return_inverse=True)[1]
    twice = (np.bincount(kind)[kind] > 1).astype(np.int64)
    steps = np.zeros(len(words) + 1, np.int64)
    steps[:n] += twice
    steps[WINDOW : WINDOW + n] -= twice
    return int((np.cumsum(steps) > 0).sum())


def measures(text: Column) -> Column:
    @F.pandas_udf(", ".join(f"{m} long" for m in MEASURES))
    def all_measures(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measured(t) for t in texts], columns=MEASURES)

    return all_measures(text)


def judged(
    docs: DataFrame, host: Column, text: str = "text", base: Mapping[str, str] = BASE_RULES,
    rules: Mapping[str, str] = HOST_RULES, limit: float = HOST_LIMIT, carry: list[str] | None = None,
) -> DataFrame:
    """Each row of `docs` as `row` (its columns, or those in `carry`), with the measures, base_failed, host_rejected, kept."""
    bounded_batches(docs.sparkSession)
    row = whole_row(docs.select(*carry)) if carry else whole_row(docs)
    rows = stored(docs.select(row.alias("row"), host.alias("host"), measures(F.col(text)).alias("m")).select("row", "host", "m.*"))
    verdicts = host_verdicts(rows, rules, limit).select(F.col("host").alias("of"), "host_rejected")
    failed = F.lit(False)
    for rule in base.values():
        failed = failed | F.expr(rule)
    rows = rows.withColumn("base_failed", failed).join(verdicts, F.col("host") == F.col("of"), "left")
    rows = rows.withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
    return rows.select(
        "row", "host", *MEASURES, "base_failed", "host_rejected", (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept")
    )


def host_verdicts(rows: DataFrame, rules: Mapping[str, str], limit: float) -> DataFrame:
    """A row for each host: host, n, the shrunk rate of each rule, host_rejected. `rows` has host and the measures."""
    counts = rows.filter("host is not null").groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(F.expr(rule).cast("long")).alias(f"f_{name}") for name, rule in rules.items()]
    )
    counts = stored(counts)
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("hosts"), *[F.sum(f"f_{r}").alias(r) for r in rules]).first()
    total = sums["n"] or 1
    mean = {r: (sums[r] or 0) / total for r in rules}
    # The spread of the hosts' rates beyond what drawing n documents gives.
    squares = [F.sum(F.col("n") * (F.col(f"f_{r}") / F.col("n") - F.lit(mean[r])) ** 2).alias(r) for r in rules]
    spread = counts.agg(*squares).first()
    rates = []
    for r in rules:
        noise = mean[r] * (1 - mean[r])
        beyond = (spread[r] or 0.0) / total - noise * sums["hosts"] / total
        weight = max(LEAST_PRIOR, min(MOST_PRIOR, noise / beyond - 1 if beyond > 0 else MOST_PRIOR))
        rates.append(((F.col(f"f_{r}") + F.lit(weight * mean[r])) / (F.col("n") + F.lit(weight))).alias(f"rate_{r}"))
    rates = counts.select("host", "n", *rates)
    return rates.withColumn("host_rejected", F.greatest(F.lit(0.0), *[F.col(f"rate_{r}") for r in rules]) > limit)
