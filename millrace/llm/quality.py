"""Quality rules on texts, with verdicts by host.

Each text is held against simple rules. How often a host's texts fail a rule is estimated by an
empirical Bayes rate: a beta prior fitted to all hosts draws the rates of small hosts to the
common one. A host's verdict then decides how strict to be with its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.functions import quoted
from millrace.llm.shared import stored
from millrace.llm.tokens import NOT_SPACE, Words, covered, words

_CONTINUES = (np.arange(256) & 0xC0) == 0x80
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")


def _text_metrics(w: Words) -> list[np.ndarray]:
    n_texts = len(w.counts)
    sums = lambda x: np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    by_text = lambda x: (s := sums(x))[w.offsets[1:]] - s[w.offsets[:-1]]
    letters = NOT_SPACE[w.data]
    word_chars = by_text(letters & ~_CONTINUES[w.data])
    symbols = by_text(_SYMBOL[w.data])

    # Lines are split at \n; those without a word do not count.
    newline = np.flatnonzero(w.data == 0x0A)
    starts = np.union1d(newline + 1, w.offsets[:-1])
    starts = starts[starts < len(w.data)]
    text = np.searchsorted(w.offsets, starts, side="right") - 1
    after = np.append(newline, len(w.data))
    ends = np.minimum(after[np.searchsorted(newline, starts)], w.offsets[text + 1])
    letter_sums = sums(letters)
    full = letter_sums[ends] > letter_sums[starts]
    starts, ends, text = starts[full], ends[full], text[full]
    hashed = w.bytes_hashed.runs(starts, ends)
    n_lines = np.bincount(text, minlength=n_texts)
    distinct = np.unique(np.stack([text.astype(np.uint64), hashed]), axis=1)[0].astype(np.int64)
    dup_lines = n_lines - np.bincount(distinct, minlength=n_texts)

    grams = w.rolling.grams(3)
    at = np.flatnonzero(w.whole(3))
    order = at[np.lexsort((grams[at], w.text_of[at]))]
    same = (grams[order[1:]] == grams[order[:-1]]) & (w.text_of[order[1:]] == w.text_of[order[:-1]])
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    repeat_words = w.per_text(covered(len(w.starts), order[twice], 3))
    return [w.counts, word_chars, symbols, dup_lines, n_lines, repeat_words]


def _measured(docs: DataFrame, text: str, host: str, with_text: bool) -> DataFrame:
    """Columns ``_row`` (the input row, without its text unless asked for), ``_host`` and metrics."""
    kept = [c for c in docs.columns if with_text or c != text]
    inputs = docs.select(
        F.struct(*map(quoted, kept)).alias("_row"),
        quoted(host).cast("string").alias("_host"),
        quoted(text).cast("binary").alias("_text"),
    )
    schema = inputs.drop("_text").schema
    for name in METRICS:
        schema = schema.add(name, "long")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [_text_metrics(w) for w in words(batch.column(2))]
            columns = [np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, columns)], names=schema.names
            )

    return inputs.mapInArrow(measure, schema)


#: Beyond the base rules, by which a text goes in any case.
BASE_RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
}
SOFT_RULES = {
    "symbols": "10 * n_symbols > word_chars",
    "repeated_lines": "n_lines >= 4 AND 2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}


def host_rates(judged: DataFrame, host: str, rules: list[str]) -> DataFrame:
    """A row per host: ``host``, its number of texts ``n``, and per rule the shrunk ``rate_<rule>``.

    ``judged`` has a boolean column per rule. The prior of a rule is a beta distribution with the
    mean of all texts and a strength fitted by moments to the spread of the hosts' rates beyond
    binomial noise, held between 1 and 1000 texts. Null hosts are one host. Counts are
    combined before the shuffle, so that a host with most of the rows costs a row per task; only
    one row of sums over all hosts comes to the driver.
    """
    counts = judged.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), *(F.sum(F.col(r).cast("long")).alias(f"n_{r}") for r in rules)
    )
    counts = stored(counts, "host-counts")
    total = counts.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
        F.count("*").alias("hosts"),
        *(F.sum(f"n_{r}").alias(f"n_{r}") for r in rules),
        *(F.sum(F.col(f"n_{r}").cast("double") * F.col(f"n_{r}") / F.col("n")).alias(f"sq_{r}") for r in rules),
    ).first()
    rates = []
    for r in rules:
        mean, strength = beta_prior(
            total["n"] or 0, total["nn"] or 0.0, total["hosts"], total[f"n_{r}"] or 0, total[f"sq_{r}"] or 0.0
        )
        rates.append(
            ((F.col(f"n_{r}") + mean * strength) / (F.col("n") + strength)).alias(f"rate_{r}")
        )
    return counts.select("host", "n", *rates)


def beta_prior(n: int, nn: float, hosts: int, failed: int, sq: float) -> tuple[float, float]:
    """Mean and strength (alpha + beta) of the beta prior.

    ``nn`` is the sum of squared numbers of texts of the hosts, ``sq`` that of squared failures
    over texts.
    """
    if not n:
        return 0.0, 1.0
    mean = failed / n
    noise = mean * (1 - mean)
    scale = n - nn / n
    variance = (sq - n * mean * mean - (hosts - 1) * noise) / scale if scale > 0 else 0.0
    strength = noise / variance - 1 if variance > 0 else 1000.0
    return mean, min(1000.0, max(1.0, strength))


def quality_verdicts(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    base_rules: dict[str, str] = BASE_RULES,
    soft_rules: dict[str, str] = SOFT_RULES,
    bad_host_rate: float = 0.8,
    trusted_rate: float = 0.001,
    with_text: bool = False,
) -> DataFrame:
    """The rows with the metrics, ``base_failed``, ``host_bad`` and ``kept``.

    A text that fails a base rule goes. For the others the host decides: if at least
    ``bad_host_rate`` of its texts fail some rule, by the shrunk rate, none of its texts is kept; a
    soft rule is enforced at a host unless its shrunk rate there is below ``trusted_rate`` (at a
    host where practically nothing fails a rule, one odd text is no junk).

    Texts are read twice, once for the hosts and once for the rows; they are never shuffled unless
    the table of hosts is too large to broadcast. Nulls: a null text has no words and so
    fails; texts of a null host are judged together. Repeated rows stay and count each. An empty
    table gives an empty result. Columns that have the name of a result column are replaced.
    ``with_text`` keeps the text among the columns.
    """
    rules = {**base_rules, **soft_rules}

    def judge(frame: DataFrame) -> DataFrame:
        failed = {f"_{r}": F.coalesce(F.expr(sql), F.lit(False)) for r, sql in rules.items()}
        frame = frame.withColumns(failed)
        return frame.withColumn("_any", F.expr(" OR ".join(failed)))

    soft = [f"_{r}" for r in soft_rules]
    rates = host_rates(judge(_measured(docs, text, host, False)), "_host", ["_any", *soft])
    judged = judge(_measured(docs, text, host, with_text))
    joined = judged.join(rates.drop("n"), F.col("_host").eqNullSafe(F.col("host")), "left")
    enforced, base = F.lit(False), F.lit(False)
    for r in soft:
        enforced = enforced | (F.col(r) & (F.col(f"rate_{r}") >= trusted_rate))
    for r in base_rules:
        base = base | F.col(f"_{r}")
    host_bad = F.col("rate__any") >= bad_host_rate
    results = [
        *map(F.col, METRICS),
        base.alias("base_failed"),
        host_bad.alias("host_bad"),
        (~base & ~host_bad & ~enforced).alias("kept"),
    ]
    own = {*METRICS, "base_failed", "host_bad", "kept"}
    kept = [c for c in docs.columns if (with_text or c != text) and c not in own]
    return joined.select(*(F.col("_row")[c].alias(c) for c in kept), *results)
