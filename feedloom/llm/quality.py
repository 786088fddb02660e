"""Quality rules by weak supervision: rules vote, expectation-maximisation weighs them, a posterior decides.

Every rule looks at the figures of one whole text and votes good (2), bad (0) or abstains (1), between the two limits. A
row's votes are its pattern. Patterns are counted over all rows, and expectation-maximisation over the counts estimates, for
each rule, how often it does each of the three on good and on bad texts, and the share of good texts. The posterior of a
pattern then replaces "all rules must pass": one weak bad vote may be outvoted, several or a telling one are enough. A rule
that never votes good speaks too: where it could have condemned a text and did not, it abstained.

Null text: empty. An empty text fails the base rules. Repeated rows, ties and null ids are rows like any other. No rows:
no rows out. The counted table has at most 3 ** (number of rules) rows, whatever the input.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .frames import append, field
from .words import _BASE, Words, mix, powers, runs

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks", "n_signs")

_SYMBOL, _UPPER, _LETTER, _MARK, _SIGN = (np.zeros(256, np.int64) for _ in range(5))
_SYMBOL[list(b"#*$%&|<>")] = 1
_UPPER[65:91] = 1
_LETTER[65:91] = _LETTER[97:123] = 1
_MARK[list(b"!?")] = 1
_SIGN[33:48] = _SIGN[58:65] = _SIGN[91:97] = _SIGN[123:127] = 1


@dataclass(frozen=True)
class Rule:
    """Votes by ``part / whole``: bad above ``bad_over`` or below ``bad_under``, good within ``good``, else no vote."""

    name: str
    part: str
    whole: str | None
    bad_over: float = np.inf
    bad_under: float = -np.inf
    good: tuple[float, float] | None = None

    def vote(self, figures: dict[str, np.ndarray]) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            x = figures[self.part] / (np.maximum(figures[self.whole], 1) if self.whole else 1.0)
        vote = np.ones(len(x), np.int64)
        if self.good is not None:
            vote[(x >= self.good[0]) & (x <= self.good[1])] = 2
        vote[(x > self.bad_over) | (x < self.bad_under)] = 0
        return vote


RULES = (
    Rule("length", "n_words", None, bad_under=50, good=(100, np.inf)),
    Rule("word length", "word_chars", "n_words", bad_over=12, bad_under=2.2, good=(3, 9)),
    Rule("symbols", "n_symbols", "n_words", bad_over=0.1, good=(0, 0.05)),
    Rule("signs in words", "n_signs", "word_chars", bad_over=0.08, good=(0, 0.04)),
    Rule("repeated lines", "n_dup_lines", "n_lines", bad_over=0.4, good=(0, 0.2)),
    Rule("repeated words", "n_repeat_words", "n_words", bad_over=0.4, good=(0, 0.1)),
    Rule("capitals", "n_upper", "n_letters", bad_over=0.5, good=(0, 0.3)),
    Rule("shouting", "n_marks", "n_words", bad_over=0.2, good=(0, 0.1)),
)


def _by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(words: Words, n: int = 3) -> np.ndarray:
    """Words of each text that stand in an ``n``-word window found twice or more in that text."""
    size = len(words)
    cover = np.zeros(size + n, bool)
    begin = np.flatnonzero(words.left() >= n)
    if len(begin):
        own = mix(words.row[begin].astype(np.uint64) + np.uint64(1))
        _, inverse, times = np.unique(runs(words.hashes(), n)[begin] ^ own, return_inverse=True, return_counts=True)
        again = begin[times[inverse] > 1]
        for i in range(n):
            cover[again + i] = True
    return _by_text(cover[:size], words.first)


def _lines(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(lines with a word, those equal to an earlier one) of each text."""
    data, offsets = words.data, words.offsets
    texts = len(offsets) - 1
    if not len(words):
        return np.zeros(texts, np.int64), np.zeros(texts, np.int64)
    begin = np.unique(np.concatenate([np.flatnonzero(data == 10) + 1, offsets]))
    begin = begin[begin < len(data)]
    upto = np.append(begin[1:], len(data))
    used = np.searchsorted(words.start, upto) > np.searchsorted(words.start, begin)
    spread = mix(np.arange(1, 257, dtype=np.uint64))
    spread[10] = 0  # the line break at the end of all lines but the last
    inside = np.arange(begin[0], len(data)) - np.repeat(begin, upto - begin)
    line = np.add.reduceat(spread[data[begin[0] :]] * powers(_BASE, int((upto - begin).max()))[inside], begin - begin[0])
    row = np.searchsorted(offsets, begin[used], "right") - 1
    key = mix(line[used]) ^ mix(row.astype(np.uint64) + np.uint64(1))
    _, first = np.unique(key, return_index=True)
    lines = np.bincount(row, minlength=texts)
    return lines, lines - np.bincount(row[first], minlength=texts)


def figures(column: pa.Array) -> dict[str, np.ndarray]:
    """The figures of each text that the rules look at."""
    words = Words.of(column)
    data, offsets = words.data, words.offsets
    point = ((data & 0xC0) != 0x80).astype(np.int64)  # one byte of each character
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(point, out=total[1:])
    lines, again = _lines(words)
    return {
        "n_words": words.count.astype(np.int64),
        "word_chars": _by_text(total[words.end] - total[words.start], words.first),
        "n_symbols": _by_text(_SYMBOL[data], offsets),
        "n_dup_lines": again.astype(np.int64),
        "n_repeat_words": _repeats(words),
        "n_lines": lines.astype(np.int64),
        "n_upper": _by_text(_UPPER[data], offsets),
        "n_letters": _by_text(_LETTER[data], offsets),
        "n_marks": _by_text(_MARK[data], offsets),
        "n_signs": _by_text(_SIGN[data], offsets),
    }


def measure(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the figures, ``base_failed`` and the ``pattern`` of votes (base 3, first rule lowest)."""

    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        made = figures(batch.column(0))
        failed = (made["n_words"] < 50) | (100 * made["n_repeat_words"] > 50 * made["n_words"])
        pattern = np.zeros(batch.num_rows, np.int64)
        for i, rule in enumerate(rules):
            pattern += rule.vote(made) * 3**i
        return {k: pa.array(v) for k, v in made.items()} | {"base_failed": pa.array(failed), "pattern": pa.array(pattern)}

    fields = [field(f, T.LongType()) for f in FIGURES]
    return append(docs, fn, [*fields, field("base_failed", T.BooleanType()), field("pattern", T.LongType())], text=text, keep=keep)


def posterior(patterns: np.ndarray, counts: np.ndarray, n_rules: int, *, prior: float = 0.9, rounds: int = 200) -> np.ndarray:
    """Probability that a row of each pattern is good.

    Each rule has three outcomes, an abstention among them. Starts from rules of equal worth: on a bad text a rule votes bad
    in two cases of five, on a good text in one of fifty, and otherwise does what it does on the whole. Rates are smoothed by
    one row each way. A bad vote is never taken as a sign of a good text, nor an abstention or a good vote against a bad one
    by more than it tells: where the estimates say otherwise, both classes get the rule's common rates.
    """
    votes = np.stack([patterns // 3**i % 3 for i in range(n_rules)], axis=1)
    rule = np.arange(n_rules)
    seen = np.stack([np.bincount(votes[:, i], weights=counts, minlength=3) + 1 for i in rule]) if len(counts) else np.ones((n_rules, 3))
    rates = np.empty((2, n_rules, 3))  # class, rule, vote
    for c, bad in enumerate((0.4, 0.02)):
        rates[c, :, 0] = bad
        rates[c, :, 1:] = (1 - bad) * seen[:, 1:] / seen[:, 1:].sum(axis=1, keepdims=True)
    share = prior
    good = np.full(len(patterns), prior)
    for _ in range(rounds):
        logs = np.log(rates[:, rule, votes]).sum(axis=2)
        odds = logs[1] - logs[0] + np.log(share) - np.log1p(-share)
        before, good = good, 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        if np.abs(good - before).max(initial=0) < 1e-9:
            break
        held = np.stack([[np.bincount(votes[:, i], weights=w, minlength=3) for i in rule] for w in (counts * (1 - good), counts * good)]) + 1
        rates = held / held.sum(axis=2, keepdims=True)
        wrong = rates[0, :, 0] < rates[1, :, 0]
        both = held.sum(axis=0)
        rates[:, wrong] = (both / both.sum(axis=1, keepdims=True))[wrong]
        share = float(np.clip((counts @ good + 1) / (counts.sum() + 2), 1e-6, 1 - 1e-6))
    return good


def fit(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(pattern, p_good) for every pattern in ``measured``: at most 3 ** rules rows, so it fits a broadcast."""
    rows = measured.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    patterns = np.array([r.pattern for r in rows], np.int64)
    counts = np.array([r.n for r in rows], float)
    good = posterior(patterns, counts, len(rules)) if rows else []
    return measured.sparkSession.createDataFrame(
        [(int(p), float(g)) for p, g in zip(patterns, good)], "pattern long, p_good double")


def judge(measured: DataFrame, model: DataFrame, *, at_least: float = 0.5) -> DataFrame:
    """``measured`` with ``p_good`` and ``kept``: no base failure and a posterior of ``at_least``."""
    found = measured.drop("p_good", "kept").join(F.broadcast(model), "pattern", "left")
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= at_least))


def keep_good(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns unchanged. Texts are read twice and not shuffled."""
    model = fit(measure(docs, text=text, keep=[]))
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{text}`").alias("body"))
    good = judge(measure(row, text="body", keep=["row"]), model)
    return good.filter("kept").select("row.*").toDF(*names)
