"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its lower-case words and their first four, five and six letters, hashed by
CRC-32. Every term of at least three texts of the learning sample gets a place in the model, whichever
class it leans to or none; a text is the set of its known terms. The machine adds a weight for each term and,
by factors, one for each pair of terms that meet in a text, so what is toxic only together counts only together.
A term's value is one plus the standard errors of its log odds, and a text's values have length one: what
tells little alone stays small in a long text, but nothing is left out.

Defined results. Null or empty text has no terms and gets the machine's base score. No labels of one
class: the share of label 1 for all. Equal texts get equal scores. Columns other than id and text are
not read, and ``keep_clean`` keeps those of its input.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.llm.common import crc_fold, release, text_of
from gridflux.llm.samples import labelled_sample

_WORD = re.compile(r"[^\W\d_]+")
MAX_PIECES = 150_000


def terms_of(piece: str) -> set[int]:
    """Hashed terms of a run of characters without white space; the kind of term stands above the CRC."""
    low = piece.lower().strip(".,;:!?'\"()")
    if low.isascii() and low.isalpha():  # one word, whose letters are bytes
        word = low.encode()
        n = len(word)
        found = {zlib.crc32(word)}
        if n >= 4:
            found.add(zlib.crc32(word[:4]) | 4 << 32)
            if n >= 5:
                found.add(zlib.crc32(word[:5]) | 5 << 32)
                if n >= 6:
                    found.add(zlib.crc32(word[:6]) | 6 << 32)
        return found
    found = set()
    for word in _WORD.findall(low):
        found.add(zlib.crc32(word.encode()))
        found.update(zlib.crc32(word[:n].encode()) | n << 32 for n in (4, 5, 6) if len(word) >= n)
    return found


def _term_array(text: str) -> np.ndarray:
    found = set().union(*map(terms_of, set(text.split())))
    return np.fromiter(found, np.int64, len(found))


@dataclass
class FactorizationMachine:
    terms: dict[int, int]  # hashed term to its place
    bias: float
    weights: np.ndarray  # a weight for each place
    factors: np.ndarray  # a row of factors for each place
    values: np.ndarray | None = None  # a value for each place, or one for all

    def places(self, seen: dict[str, tuple[int, ...]], text: str) -> np.ndarray:
        """Places of the text's known terms. ``seen`` keeps those of pieces met before."""
        found: list[int] = []
        if len(seen) > MAX_PIECES:
            seen.clear()
        terms = self.terms
        for piece in set(text.split()):
            known = seen.get(piece)
            if known is None:
                known = seen[piece] = tuple([terms[t] for t in terms_of(piece) if t in terms])
            found += known
        return np.unique(np.array(found, np.int64))

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.empty(len(rows))
        for k, at in enumerate(rows):
            x = np.ones(len(at)) if self.values is None else self.values[at] / max(np.linalg.norm(self.values[at]), 1.0)
            v = self.factors[at] * x[:, None]
            out[k] = self.bias + self.weights[at] @ x + 0.5 * (np.square(v.sum(0)) - np.square(v).sum(0)).sum()
        return 1 / (1 + np.exp(-np.clip(out, -50, 50)))


def train_machine(rows: list[np.ndarray], y: np.ndarray, n_terms: int, n_factors: int = 8, steps: int = 20, batch: int = 128, rate: float = 0.2, ridge: float = 1e-4, seed: int = 3, values: np.ndarray | None = None) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors by AdaGrad on the logistic loss; both classes weigh the same.

    With ``values`` of the terms, those of each text are scaled to length one; a batch changes its own terms only.
    Inside, each factor is a row of its own, and a batch numbers its terms by a table instead of sorting them.
    """
    rng = np.random.default_rng(seed)
    bias, w, v = 0.0, np.zeros(n_terms), rng.normal(0, 0.02, (n_terms, n_factors)).T.copy()
    gb, gw, gv = 1e-3, np.full(n_terms, 1e-3), np.full((n_factors, n_terms), 1e-3)
    here, number = np.zeros(n_terms, bool), np.zeros(n_terms, np.int64)
    weigh = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    long = np.ones(len(rows)) if values is None else np.array([max(np.linalg.norm(values[r]), 1.0) for r in rows])
    for _ in range(steps):
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // batch)):
            count = np.array([len(rows[i]) for i in part])
            met = np.concatenate([rows[i] for i in part]).astype(np.int64)
            here[met] = True
            at = np.flatnonzero(here)
            here[at], number[at] = False, np.arange(len(at))
            back = number[met]
            of = np.repeat(np.arange(len(part)), count)
            x = (np.ones(len(at)) if values is None else values[at])[back] / long[part][of]
            own = v[:, at]
            vs = own.take(back, 1) * x
            ends = np.cumsum(count)
            sums = np.zeros((n_factors, len(met) + 1))
            np.cumsum(vs, 1, out=sums[:, 1:])
            total = sums[:, ends] - sums[:, ends - count]
            square = np.bincount(of, weights=np.square(vs).sum(0), minlength=len(part))
            linear = np.bincount(of, weights=w[at][back] * x, minlength=len(part))
            p = 1 / (1 + np.exp(-np.clip(bias + linear + 0.5 * (np.square(total).sum(0) - square), -50, 50)))
            g = weigh[part] * (p - y[part]) / len(part)
            gx = g[of] * x
            db, dw = g.sum(), np.bincount(back, weights=gx, minlength=len(at))
            dv = np.stack([np.bincount(back, weights=gx * (total[k][of] - vs[k]), minlength=len(at)) for k in range(n_factors)])
            dw += ridge * w[at] / len(part)
            dv += ridge * own / len(part)
            gb += db * db
            gw[at] += dw * dw
            spread = gv[:, at] + dv * dv
            gv[:, at] = spread
            bias -= rate * db / np.sqrt(gb)
            w[at] -= rate * dw / np.sqrt(gw[at])
            v[:, at] = own - rate * dv / np.sqrt(spread)
    return bias, w, v.T.copy()


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = 4000, max_chars: int = 20_000, min_texts: int = 3) -> FactorizationMachine:
    """Learn from at most ``rows_per_class`` labelled texts of each class; they bound the number of terms.

    A term gets a place if it stands in ``min_texts`` texts or more.
    """
    texts, y, share = labelled_sample(docs, labels, "toxic", rows_per_class, max_chars)
    base = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    empty = FactorizationMachine({}, base, np.empty(0), np.empty((0, 1)))
    if len(set(y.tolist())) < 2:
        return empty
    sets = [_term_array(t) for t in texts]  # eight bytes a term
    del texts
    terms, count = np.unique(np.concatenate(sets), return_counts=True)
    terms = terms[count >= min_texts]
    if not len(terms):
        return empty
    rows = []
    for k, found in enumerate(sets):
        at = np.minimum(np.searchsorted(terms, found), len(terms) - 1)
        rows.append(np.sort(at[terms[at] == found]).astype(np.int32))
        sets[k] = None
    a, b = (np.bincount(np.concatenate([r for r, c in zip(rows, y, strict=True) if c == k]), minlength=len(terms)) for k in (1, 0))
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    odds = np.log((a + 0.5) / (n1 - a + 0.5)) - np.log((b + 0.5) / (n0 - b + 0.5))
    values = 1 + np.abs(odds) / np.sqrt(1 / (a + 0.5) + 1 / (n1 - a + 0.5) + 1 / (b + 0.5) + 1 / (n0 - b + 0.5))
    bias, w, v = train_machine(rows, y.astype(float), len(terms), values=values)
    return FactorizationMachine({t: k for k, t in enumerate(terms.tolist())}, bias, w, v, values)


def _scored(texts: DataFrame, machine: FactorizationMachine, key: str) -> DataFrame:
    held = texts.sparkSession.sparkContext.broadcast(machine)  # bounded by the learning sample

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            p = held.value.score([held.value.places(seen, t.as_py()) for t in batch["text"]])
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(p, pa.float64())], [key, "score"])

    return texts.mapInArrow(score, f"{key} long, score double")


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of each document; rows whose crc32(doc_id) mod 5 is 0
    are held out from learning."""
    machine = fit(docs, labels.where(crc_fold("doc_id", 5) != 0))
    scored = _scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")), machine, "doc_id")
    held_out = F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, machine: FactorizationMachine, threshold: float = 0.5) -> DataFrame:
    """The documents whose score stays under the threshold, with the columns they came with."""
    held = docs.sparkSession.sparkContext.broadcast(machine)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        seen: dict[str, tuple[int, ...]] = {}
        p = pa.array(held.value.score([held.value.places(seen, t.as_py()) for t in text]), pa.float64())
        del seen
        release()
        return p

    return docs.where(score(text_of("text")) < threshold)
