"""Quality rules: decision lists learned by sequential covering.

Per-document statistics come from one vectorised pass over whole texts.  From
a bounded sample of labelled rows, rules (conjunctions of thresholds) are grown
greedily by FOIL gain on one part of the sample and pruned on the other, until
no rule covers enough bad documents at the asked precision.  The list becomes
one ordered Spark CASE expression, so it stays readable and runs JVM-side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import uniform
from .words import Words, chunks

STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits",
)
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: Bytes of text whose rows a worker hands back at once.
BATCH_BYTES = 1 << 22
#: Labelled rows that training reads at most (the documented bound of the sample).
SAMPLE_ROWS = 20_000


def _marker(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_IS_SYMBOL, _IS_UPPER = _marker(SYMBOLS), _marker(bytes(range(65, 91)))
_IS_MARK, _IS_DIGIT = _marker(b"!?"), _marker(b"0123456789")


def _per_doc(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (document, key) rows: whether the pair occurs more than once, and whether it occurred earlier."""
    order = np.lexsort((keys, docs))
    k, d = keys[order], docs[order]
    same = np.zeros(len(k), bool)
    same[1:] = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    often, later = same.copy(), np.zeros(len(k), bool)
    often[:-1] |= same[1:]
    twice = np.zeros(len(k), bool)
    twice[order], later[order] = often, same  # lexsort is stable: the first of equals comes first
    return twice, later


def text_statistics(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The columns of ``STATISTICS`` for a run of documents."""
    n = len(offsets) - 1
    words = Words(data, offsets)
    hashes = words.hashes()
    starting = (data & 0xC0) != 0x80  # first byte of a code point
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(starting, out=total[1:])
    chars = np.bincount(words.doc, weights=total[words.ends] - total[words.starts], minlength=n).astype(np.int64)

    grams, valid = words.runs(hashes, WINDOW)
    at = np.flatnonzero(valid)
    twice, _ = _repeats(grams[at], words.doc[at])
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    repeated = np.bincount(words.doc[np.cumsum(cover[:-1]) > 0], minlength=n)

    # A line is told by the bytes between its breaks; lines without a word don't count.
    breaks = data == 10
    line_start = np.zeros(len(data) + 1, bool)
    line_start[1:] = breaks
    line_start[offsets] = True
    line_at = np.flatnonzero(line_start[: len(data)])
    line_end = np.append(line_at, len(data))[1:]
    line_end = line_end - breaks[line_end - 1]
    line_doc = np.searchsorted(offsets, line_at, "right") - 1
    line_hash = np.array([hash(data[a:b].tobytes()) for a, b in zip(line_at, line_end, strict=True)], dtype=np.int64)
    has_word = np.searchsorted(words.starts, line_end) > np.searchsorted(words.starts, line_at)
    line_doc, line_hash = line_doc[has_word], line_hash[has_word]
    _, earlier = _repeats(line_hash, line_doc)
    return [
        words.counts.astype(np.int64), chars, _per_doc(_IS_SYMBOL[data], offsets),
        np.bincount(line_doc[earlier], minlength=n), repeated, np.bincount(line_doc, minlength=n),
        _per_doc(_IS_UPPER[data], offsets), _per_doc(_IS_MARK[data], offsets), _per_doc(_IS_DIGIT[data], offsets),
    ]


def with_statistics(docs: DataFrame, text: str = "text", drop_text: bool = False) -> DataFrame:
    """``docs`` with the columns of ``STATISTICS`` (long); columns of these names are replaced.

    NULL text counts as empty.  ``drop_text`` leaves the text out of the result.
    """
    docs = docs.drop(*STATISTICS)
    keep = [f for f in docs.schema.fields if not (drop_text and f.name == text)]
    schema = T.StructType([*keep, *[T.StructField(s, T.LongType()) for s in STATISTICS]])
    names = [f.name for f in keep]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            begin, held, parts = 0, 0, []
            for _, end, data, offsets in chunks(batch.column(text)):
                parts.append(text_statistics(data, offsets))
                held += len(data)
                if held >= BATCH_BYTES or end == batch.num_rows:
                    columns = [pa.array(np.concatenate([p[i] for p in parts]), pa.int64()) for i in range(len(STATISTICS))]
                    rows = batch.slice(begin, end - begin)
                    yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in names], *columns], names=[*names, *STATISTICS])
                    begin, held, parts = end, 0, []

    return docs.mapInArrow(measure, schema)


#: Features of the rules: ratios of statistics, so that they mean the same for any length.
FEATURES = {
    "words": "CAST(n_words AS DOUBLE)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
}


@dataclass(frozen=True)
class Rule:
    """A conjunction of ``(feature, sign, threshold)``; sign is ``">"`` or ``"<="``."""

    terms: tuple[tuple[str, str, float], ...]

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, sign, limit in self.terms:
            out &= (x[name] > limit) if sign == ">" else (x[name] <= limit)
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for name, sign, limit in self.terms:
            value = F.expr(FEATURES[name])
            out = out & ((value > limit) if sign == ">" else (value <= limit))
        return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, max_terms: int, cuts: int) -> Rule:
    """Adds the term of largest FOIL gain until the rule covers bad rows only."""
    inside, terms = np.ones(len(bad), bool), []
    while len(terms) < max_terms and (~bad & inside).any():
        p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
        best = (1e-9, None, None)
        for name, values in x.items():
            v = values[inside]
            limits = np.unique(np.quantile(v, np.linspace(0, 1, cuts + 1)[:-1]))
            order = np.argsort(v, kind="stable")
            good_up, bad_up = np.cumsum(~bad[inside][order]), np.cumsum(bad[inside][order])
            at = np.searchsorted(v[order], limits, "right") - 1
            for sign, p, n in (("<=", bad_up[at], good_up[at]), (">", p0 - bad_up[at], n0 - good_up[at])):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / np.maximum(p + n, 1)) - np.log2(p0 / (p0 + n0))), 0.0)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (float(gain[i]), (name, sign, float(limits[i])), None)
        if best[1] is None:
            break
        terms.append(best[1])
        inside &= Rule((best[1],)).holds(x)
    return Rule(tuple(terms))


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Drops final terms while that doesn't lower (p - n) / (p + n) on the pruning part."""

    def worth(r: Rule) -> float:
        inside = r.holds(x)
        p, n = (bad & inside).sum(), (~bad & inside).sum()
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for k in range(len(rule.terms) - 1, 0, -1):
        shorter = Rule(rule.terms[:k])
        if worth(shorter) >= worth(best):
            best = shorter
    return best


def learn_rules(
    x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.9, min_cover: int = 5,
    max_rules: int = 16, max_terms: int = 4, cuts: int = 64, seed: int = 5,
) -> list[Rule]:
    """The decision list: a document under any rule is bad, any other good.

    A rule is kept if at least ``precision`` of the rows it covers (on the whole
    sample that is left) are bad.  Without bad rows the list is empty.
    """
    rng = np.random.default_rng(seed)
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < max_rules and (bad & left).sum() >= min_cover:
        growing = left & (rng.random(len(bad)) < 2 / 3)
        pruning = left & ~growing
        rule = _grow({k: v[growing] for k, v in x.items()}, bad[growing], max_terms, cuts)
        if not rule.terms:
            break
        rule = _prune(rule, {k: v[pruning] for k, v in x.items()}, bad[pruning])
        inside = rule.holds(x) & left
        covered, hit = inside.sum(), (bad & inside).sum()
        if hit < min_cover or hit < precision * covered:
            break
        rules.append(rule)
        left &= ~inside
    return rules


def training_rows(
    docs: DataFrame, labels: DataFrame, inputs: dict[str, str], text: str, key: str, label: str, sample_rows: int, seed: int,
) -> pd.DataFrame:
    """``(_good, key, *inputs)`` of the documents of at most ``sample_rows`` labelled ids, those of smallest hash.

    Repeated rows of an id and text count once.  Should ids have several texts,
    at most ``4 * sample_rows`` rows are taken, by the hash of id and text.
    """
    picked = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(key).agg(F.max(label).alias("_good"))
        .orderBy(uniform(seed, key), key).limit(sample_rows)
    )
    rows = docs.select(key, text).join(F.broadcast(picked), key, "inner")  # bounded by sample_rows
    rows = rows.dropDuplicates([key, text]).withColumn("_at", uniform(seed, key, text))
    sample = (
        with_statistics(rows, text, drop_text=True)
        .select("_good", key, "_at", *[F.expr(e).alias(f) for f, e in inputs.items()])
        .orderBy("_at", key, *inputs).limit(4 * sample_rows)
    )
    return sample.drop("_at").toPandas().sort_values([key, *inputs], ignore_index=True)


def fit_rules(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS, seed: int = 5, **options,
) -> list[Rule]:
    """Learns the list from at most ``sample_rows`` labelled rows, those of smallest hash.

    Only the sample's documents are measured; its statistics (a few numbers a
    row) are what reaches the driver.  Rows with a NULL key or label don't count.
    """
    sample = training_rows(docs, labels, FEATURES, text, key, label, sample_rows, seed)
    if not len(sample):
        return []
    x = {f: sample[f].to_numpy(float) for f in FEATURES}
    return learn_rules(x, (sample["_good"] <= 0).to_numpy(bool), seed=seed, **options)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """``(kept, rule)``: the ordered CASE of the list, and which rule decided (-1: the base, NULL: none)."""
    number = F.when(base_failed(), F.lit(-1))
    for i, rule in enumerate(rules):
        number = number.when(rule.column(), F.lit(i))
    return number.isNull(), number


def describe(rules: list[Rule]) -> list[str]:
    return [" and ".join(f"{n} {s} {t:.6g}" for n, s, t in r.terms) for r in rules]


def quality_rules(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", drop_text: bool = False, **options) -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, ``kept`` and ``rule``.

    Empty and NULL texts fail the base (fewer than 10 words).  Without labelled
    bad rows only the base decides.  Existing columns of these names are replaced.
    """
    rules = fit_rules(docs, labels, text, key, **options)
    measured = with_statistics(docs.drop("base_failed", "kept", "rule"), text, drop_text)
    kept, number = verdict(rules)
    return measured.withColumns({"base_failed": base_failed(), "kept": kept, "rule": number})
