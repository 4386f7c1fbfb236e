"""Quality rules: text statistics, and a learned decision list over them.

Statistics are counted per text with vectorised byte operations. The list is learned by
sequential covering on a bounded sample of labelled rows: a rule starts empty and grows by
the threshold condition with the largest information gain on the growing part, is pruned
from its end while precision on the pruning part improves, and enters the list if it is
precise enough there; the rows that it covers leave, and the next rule is learned. The list
becomes one ordered Spark conditional expression; nothing learned runs in Python.

Defined results: null and empty texts have zero counts and fail the base rules; repeated
rows give equal rows; without labels of both kinds the list is empty and keeps all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .labelled import one_text, sample

#: Labelled rows that the list is learned from.
MAX_TRAIN = 20000
#: Share of rejected rows that must be labelled low, on rows the rule wasn't grown on and over all.
LEAST_PRECISION = 0.95
MAX_RULES, MAX_CONDITIONS, MIN_COVER = 16, 4, 10

_BYTES = np.arange(256)
SYMBOL = np.isin(_BYTES, np.frombuffer(b"#*$%&|<>", np.uint8))
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 0xC0)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_MARK = np.isin(_BYTES, np.frombuffer(b"!?", np.uint8))
_LINE = _BYTES != 10
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_digits", "n_marks", "n_distinct_words"]
#: What conditions are about: per-word and per-line shares of the counts.
FEATURES = {
    "n_words": ("n_words", None), "word_length": ("word_chars", "n_words"), "symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"),
    "repeated": ("n_repeat_words", "n_words"), "upper": ("n_upper", "n_letters"), "digits": ("n_digits", "word_chars"), "marks": ("n_marks", "n_words"),
    "distinct": ("n_distinct_words", "n_words"), "line_words": ("n_words", "n_lines"),
}


def _repeats(keys: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text the distinct keys; and per key whether its text has it twice or more."""
    _, first, inverse, count = np.unique(keys ^ K.mix(doc.astype(K.U64) + K.U64(1)), return_index=True, return_inverse=True, return_counts=True)
    return np.bincount(doc[first], minlength=n), (count >= 2)[inverse] if len(keys) else np.zeros(0, bool)


def count_texts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The :data:`COUNTS` of consecutive texts."""
    n = len(offsets) - 1
    text = data[offsets[0]:offsets[-1]]
    own = offsets - offsets[0]
    per = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[own])
    words = K.find_words(text, own, K.NONSPACE, K.SAME)
    n_words = np.diff(words.first)
    doc = words.doc
    distinct_words, _ = _repeats(words.hashes, doc, n)
    hashes, inside = K.windows(words, 3)
    at = np.flatnonzero(inside)
    _, twice = _repeats(hashes[at], doc[at], n)
    mark = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(mark, at[twice], 1)
    np.add.at(mark, at[twice] + 3, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(mark)[:-1] > 0)])
    lines = K.find_words(text, own, _LINE, K.SAME)
    solid = np.concatenate([[0], np.cumsum(K.NONSPACE[text])])
    worded = solid[lines.ends] > solid[lines.starts]
    line_doc = lines.doc[worded]
    n_lines = np.bincount(line_doc, minlength=n)
    distinct_lines, _ = _repeats(lines.hashes[worded], line_doc, n)
    return [n_words, per(K.NONSPACE[text] & ((text & 0xC0) != 0x80)), per(SYMBOL[text]), n_lines - distinct_lines,
            covered[words.first[1:]] - covered[words.first[:-1]], n_lines, per(_UPPER[text]), per(_LETTER[text]), per(_DIGIT[text]), per(_MARK[text]), distinct_words]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the :data:`COUNTS` (bigint) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = K.text_bytes(batch.column(1))
        parts = [count_texts(data, offsets[lo:hi + 1]) for lo, hi in K.row_groups(offsets)]
        cols = [pa.array(np.concatenate([p[i] for p in parts]).astype(np.int64)) for i in range(len(COUNTS))]
        return pa.RecordBatch.from_arrays([batch.column(0), *cols], names=[id_col, *COUNTS])

    return K.text_map(docs.select(id_col, text_col), run, f"{id_col} {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature >= threshold, else feature < threshold
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.above else x[self.feature] < self.threshold

    def column(self) -> Column:
        c = feature_column(self.feature)
        return c >= F.lit(self.threshold) if self.above else c < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:g}"


def feature_column(name: str) -> Column:
    part, whole = FEATURES[name]
    value = F.col(part).cast("double")
    return value if whole is None else value / F.greatest(F.col(whole), F.lit(1)).cast("double")


def feature_arrays(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {f: counts[a].astype(float) if b is None else counts[a] / np.maximum(counts[b], 1).astype(float) for f, (a, b) in FEATURES.items()}


def _grow(x: dict[str, np.ndarray], low: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    on = np.ones(len(low), bool)
    while len(rule) < MAX_CONDITIONS and on.any() and not low[on].all():
        p, n = low[on].sum(), (~low[on]).sum()
        base = np.log2(max(p, 1e-9) / (p + n))
        best, gain = None, 1e-6
        for f in FEATURES:
            values = x[f][on]
            for t in np.unique(np.quantile(values, np.linspace(0, 1, 65), method="nearest")):
                above = values >= t
                for side in (True, False):
                    inside = above if side else ~above
                    a, b = low[on][inside].sum(), (~low[on][inside]).sum()
                    if a + b >= MIN_COVER and a and (g := a * (np.log2(a / (a + b)) - base)) > gain:
                        best, gain = Condition(f, side, float(t)), g
        if best is None:
            break
        rule.append(best)
        on &= best.holds(x)
    return rule


def _worth(rule: list[Condition], x: dict[str, np.ndarray], low: np.ndarray) -> tuple[float, float]:
    """(p - n) / (p + n) and the smoothed precision on these rows."""
    on = np.ones(len(low), bool)
    for c in rule:
        on &= c.holds(x)
    p, n = low[on].sum(), (~low[on]).sum()
    return ((p - n) / (p + n) if p + n else -1.0), (p + 1) / (p + n + 2)


def learn(x: dict[str, np.ndarray], low: np.ndarray, seed: int = 7) -> list[list[Condition]]:
    """An ordered list of conjunctions that each reject; a row that none covers is kept."""
    rules: list[list[Condition]] = []
    left = np.ones(len(low), bool)
    rng = np.random.default_rng(seed)
    part = rng.random(len(low)) < 2 / 3
    while len(rules) < MAX_RULES and low[left].any():
        grow, prune = left & part, left & ~part
        pick = lambda rows: ({f: v[rows] for f, v in x.items()}, low[rows])
        rule = _grow(*pick(grow))
        while len(rule) > 1 and _worth(rule[:-1], *pick(prune))[0] >= _worth(rule, *pick(prune))[0]:
            rule = rule[:-1]
        # on the pruning part it must be as pure as asked, and over both the smoothed precision must be
        if not rule or (_worth(rule, *pick(prune))[0] + 1) / 2 < LEAST_PRECISION or _worth(rule, *pick(left))[1] < LEAST_PRECISION:
            break
        rules.append(rule)
        on = left.copy()
        for c in rule:
            on &= c.holds(x)
        left &= ~on
    return rules


def expression(rules: list[list[Condition]]) -> Column:
    """The list as an ordered conditional: true keeps."""
    out = None
    for rule in rules:
        fires = rule[0].column()
        for c in rule[1:]:
            fires = fires & c.column()
        out = F.when(fires, F.lit(False)) if out is None else out.when(fires, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def learn_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                max_train: int = MAX_TRAIN) -> list[list[Condition]]:
    """The decision list from at most ``max_train`` labelled rows (1 is good, 0 is low)."""
    chosen = sample(labels, id_col, label_col, max_train)
    train = one_text(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), chosen)
    rows = statistics(train.select("id", "text"), "id", "text").join(F.broadcast(chosen), "id").orderBy("id", *COUNTS).select("label", *COUNTS).toPandas()
    if rows["label"].nunique() < 2:
        return []
    x = feature_arrays({c: rows[c].to_numpy() for c in COUNTS})
    return learn(x, rows["label"].to_numpy() == 0)


def apply_rules(docs: DataFrame, rules: list[list[Condition]], id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every row."""
    stats = statistics(docs, id_col, text_col)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & expression(rules))
