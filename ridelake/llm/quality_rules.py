"""Quality rules as weak supervision: rules vote, EM weighs them, a posterior decides.

Each rule looks at one figure of a text and votes for good (1), for bad (-1) or
abstains (0). The label model has two hidden classes and, for each rule, the
probability of each vote given the class (independent given the class). A rule that
abstains is no evidence: kinds of bad text exclude each other, so silence of the rules
for the other kinds says nothing.
Expectation-maximisation runs on the counts of the vote patterns of the whole
table: at most 3 ** rules rows whatever the size of the corpus, counted by Spark.
A text is kept if the posterior probability of good is at least a half.

Null text counts as empty: no words, base failed, not kept. Repeated rows are
counted and returned each; ties do not arise; an empty table gives an empty
result. Very long texts are counted whole. Only the id and text columns are read, so other
columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import (
    Words,
    by_row,
    grams,
    in_rows,
    pieces_of,
    ready,
    span_hashes,
    stored,
)

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
FIGURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
    "n_bangs",
)


def repeated_words(words: Words) -> np.ndarray:
    """Words, by text, in three-word windows that occur twice or more in the text."""
    valid = np.flatnonzero(words.full(3))
    key = in_rows(grams(words.hashes(), 3)[valid], words.row[valid])
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    cover = np.zeros(len(words.row) + 2, bool)
    twice = np.unique(valid[np.concatenate((order[1:][same], order[:-1][same]))])
    for k in range(3):
        cover[twice + k] = True
    return by_row(cover[: len(words.row)], words.offsets)


def line_counts(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them equal to an earlier line, by text."""
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    starts = starts[starts < len(data)]
    row = np.searchsorted(offsets, starts, "right") - 1
    # A line ends at its break or at the end of its text.
    limits = np.append(breaks, len(data))
    ends = np.minimum(limits[np.searchsorted(breaks, starts)], offsets[row + 1])
    worded = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
    some = worded[ends] > worded[starts]
    starts, ends, row = starts[some], ends[some], row[some]
    rows = len(offsets) - 1
    count = np.bincount(row, minlength=rows)
    _, first = np.unique(in_rows(span_hashes(data, starts, ends), row), return_index=True)
    return count, count - np.bincount(row[first], minlength=rows)


def figures_of(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    words = Words(data, offsets)
    lead = (data & 0xC0) != 0x80
    upper = (data >= 65) & (data <= 90)
    # Letters beyond ASCII count by their lead bytes, as lower case.
    letters = upper | ((data >= 97) & (data <= 122)) | (data >= 0xC0)
    lines, repeats = line_counts(data, offsets, words.inside)
    return {
        "n_words": words.counts,
        "word_chars": by_row(words.inside & lead, offsets),
        "n_symbols": by_row(SYMBOLS[data], offsets),
        "n_dup_lines": repeats,
        "n_repeat_words": repeated_words(words),
        "n_lines": lines,
        "n_upper": by_row(upper, offsets),
        "n_letters": by_row(letters, offsets),
        "n_bangs": by_row(data == 33, offsets),
    }


def text_figures(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The figures that the rules look at, one row per input row."""
    ready(docs.sparkSession)
    kind = docs.schema[id_column].dataType
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for low, high, data, offsets in pieces_of(batch.column("text")):
                got = figures_of(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), *(pa.array(got[f].astype(np.int64)) for f in FIGURES)],
                    names=["doc_id", *FIGURES],
                )

    return source.mapInArrow(run, f"doc_id {kind.simpleString()}, " + ", ".join(f"{f} long" for f in FIGURES))


def vote(bad: Column, good: Column | None = None) -> Column:
    against = F.when(bad, -1)
    return (against if good is None else against.when(good, 1)).otherwise(0).cast("tinyint")


def rules() -> dict[str, Column]:
    """Votes by rule, over the figures. All compare whole numbers.

    Most rules know one kind of bad text and abstain on all others.
    """
    c = {f: F.col(f) for f in FIGURES}
    n = c["n_words"]
    return {
        "length": vote(n < 20, n >= 50),
        "word_length": vote((n == 0) | (c["word_chars"] < 2 * n) | (c["word_chars"] > 14 * n)),
        "symbols": vote(10 * c["n_symbols"] > n),
        "lines": vote(10 * c["n_dup_lines"] > 3 * c["n_lines"]),
        "repeats": vote(5 * c["n_repeat_words"] > n),
        "capitals": vote(4 * c["n_upper"] > c["n_letters"]),
        "exclamation": vote(10 * c["n_bangs"] > n),
    }


@dataclass(frozen=True)
class LabelModel:
    """prior: probability of good; chance[rule, class, vote + 1], class 1 is good."""

    prior: float
    chance: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        odds = np.log(self.prior) - np.log1p(-self.prior)
        return odds + self.weights()[np.arange(votes.shape[1]), votes + 1].sum(axis=1)

    def weights(self) -> np.ndarray:
        """What each vote adds to the log-odds of good; abstaining adds nothing."""
        out = np.log(self.chance[:, 1]) - np.log(self.chance[:, 0])
        out[:, 1] = 0
        return out


def fit(
    votes: np.ndarray, counts: np.ndarray, floor: float = 0.8, rounds: int = 500, tolerance: float = 1e-9
) -> LabelModel:
    """EM over vote patterns (patterns x rules) and how often each occurs.

    The one assumption is that of weak supervision: rules that vote are more often
    right than wrong, here at least in a share `floor` of their votes. A maximisation
    step that would fall below it is moved back to it; without that, EM takes the most
    frequent kind of bad text for the whole class. Masses are smoothed by one.
    """
    size = votes.shape[1]
    model = LabelModel(0.9, np.tile(np.array([[0.3, 0.5, 0.2], [0.01, 0.69, 0.3]]), (size, 1, 1)))
    if not counts.sum():
        return model
    marks = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(rounds):
        good = 1 / (1 + np.exp(-np.clip(model.log_odds(votes), -500, 500)))
        weight = np.stack([counts * (1 - good), counts * good])
        mass = np.einsum("cp,prv->rcv", weight, marks)
        total = weight.sum(axis=1)
        chance = np.empty_like(mass)
        for place, right in ((0, 0), (2, 1)):
            cast = mass[:, :, place].sum(axis=1)
            sure = np.maximum(mass[:, right, place], floor * cast)
            chance[:, right, place] = (sure + 1) / (total[right] + 3)
            chance[:, 1 - right, place] = (cast - sure + 1) / (total[1 - right] + 3)
        chance[:, :, 1] = np.maximum(1 - chance[:, :, 0] - chance[:, :, 2], 1e-3)
        chance /= chance.sum(axis=2, keepdims=True)
        new = LabelModel(float((total[1] + 1) / (counts.sum() + 2)), chance)
        moved = max(abs(new.prior - model.prior), float(np.abs(new.chance - model.chance).max()))
        model = new
        if moved < tolerance:
            break
    return model


def weak_quality(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = 0.5
) -> tuple[DataFrame, LabelModel]:
    """Figures, votes and the posterior probability of good for each text, and the model."""
    figures = stored(text_figures(docs, id_column, text))
    by_rule = rules()
    voted = figures.select("*", *(v.alias(f"vote_{r}") for r, v in by_rule.items()))
    names = [f"vote_{r}" for r in by_rule]
    # At most 3 ** 7 patterns, whatever the size of the corpus.
    found = voted.groupBy(*names).agg(F.count("*").alias("n")).collect()
    votes = np.array([[r[n] for n in names] for r in found], dtype=np.int64).reshape(-1, len(names))
    order = np.lexsort(votes.T) if len(votes) else np.zeros(0, np.int64)
    model = fit(votes[order], np.array([r["n"] for r in found], dtype=float)[order])
    by_vote = model.weights()
    odds = F.lit(float(np.log(model.prior) - np.log1p(-model.prior)))
    for k, name in enumerate(names):
        bad, none, good = (float(x) for x in by_vote[k])
        odds = odds + F.when(F.col(name) < 0, bad).when(F.col(name) > 0, good).otherwise(none)
    posterior = F.lit(1.0) / (1 + F.exp(-odds))
    out = voted.withColumn("posterior", posterior)
    return out.withColumn("good", F.col("posterior") >= threshold), model


def op5_quality_rules(docs: DataFrame) -> DataFrame:
    judged, _ = weak_quality(docs)
    n, repeats = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < 50) | (100 * repeats > 50 * n)
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("good")).alias("kept"),
        F.round("posterior", 9).alias("posterior"),
    )
