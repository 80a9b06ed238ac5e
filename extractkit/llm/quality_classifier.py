"""Document quality by co-training a text view and a page-metadata view.

The text view hashes the words of a text (presence, ``2 ** BITS`` slots) and classes of its
shares of symbols, capitals and distinct words; every slot counts, the less the more its
difference between labels may be chance.  The metadata view takes source, language and length class.  Each has a logistic regression.  Both start from
the labelled documents; in each round a view labels all unlabelled documents, and what it is
sure of becomes training material of the other view, which also values its slots anew.  Each view's score is calibrated on
labelled documents kept aside, and a last regression of the two calibrated scores there
gives the probability of a document being good.

Up to ``MAX_LABELLED`` labelled documents, drawn by a hash of ``doc_id``, are fitted on in the
driver.  Unlabelled ones all take part, as Spark jobs that sum counts and gradients by slot
in each task first; every document is scored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from extractkit.llm.common import small_batches, stored
from extractkit.session import spread

BITS, META_BITS = 17, 10
SIZES = (1 << BITS, 1 << META_BITS)
MAX_LABELLED = 12_000
ROUNDS = 3
#: Steps of a round that take in the unlabelled documents, one Spark job each.
POOL_STEPS = 5
SURE = 0.98
#: Parts of the labelled rows that are calibrated on in turn.
FOLDS = 5
#: A slot of the text view has its full value if its shares among good documents and among those of
#: low quality, or toxic ones, differ by so many standard errors.  Below, the value falls by this
#: power of the errors: many words of chance weigh little, and none is left out.
FULL_ERRORS, FALL = 4.0, 8
#: Documents with a lower probability of being good are rejected.
THRESHOLD = 0.3

_LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not (48 <= c <= 57 or 97 <= c <= 122) else c for c in range(256))
_SYMBOLS, _CAPITALS = b"#*$%&|<>!", bytes(range(65, 91))
SCORES = "text_score double, page_score double, quality_score double, kept boolean"


def text_slots(text: bytes | None) -> np.ndarray:
    """Slots of the distinct words of a UTF-8 text, A-Z lower-cased, without ASCII marks, and of its shares."""
    found = text.translate(_LOWER).split() if text else []
    words = set(found)
    size = max(1, len(text or b""))
    for name, part in (("symbols", _SYMBOLS), ("capitals", _CAPITALS)):
        share = (size - len(text.translate(None, part))) / size if text else 0.0
        words.add(b"%s %d" % (name.encode(), min(20, int(40 * share))))
    words.add(b"distinct %d" % int(10 * len(words) / max(1, len(found))) if len(found) >= 20 else b"short")
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) & ((1 << BITS) - 1)


def page_slots(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """Slots of source, language and length class; nulls are values of their own."""
    length = "" if n_chars is None else str(max(0, n_chars).bit_length())
    names = (f"source={source}", f"lang={lang}", f"length={length}", f"lang={lang} length={length}")
    return np.fromiter((zlib.crc32(x.encode()) for x in names), np.int64, len(names)) & ((1 << META_BITS) - 1)


class Examples:
    """Rows of slots as two flat arrays."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        self.slots = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        self.rows = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """``weights`` ends with the intercept."""
        return np.bincount(self.rows, weights[self.slots], self.n) + weights[-1]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _counts(examples: Examples, kinds: np.ndarray, kind: int, size: int) -> tuple[np.ndarray, int]:
    """How many rows of a kind have each slot, and how many there are."""
    return np.bincount(examples.slots[kinds[examples.rows] == kind], minlength=size), (kinds == kind).sum()


def slot_values(examples: Examples, kinds: np.ndarray, size: int, more: tuple | None = None) -> np.ndarray:
    """The value of each slot, 0 to 1, by how surely its shares among kind 1 and another kind differ.

    ``more``: counts of slots and rows of further documents, bad ones (a kind of their own) and good ones.
    """
    groups = [_counts(examples, kinds, kind, size) for kind in (0, 2)]
    in_good, n_good = _counts(examples, kinds, 1, size)
    if more:
        groups.append(more[0])
        in_good, n_good = in_good + more[1][0], n_good + more[1][1]
    n_good, most = max(1, n_good), np.zeros(size)
    for in_bad, n_bad in groups:
        if n_bad:
            share = (in_good + in_bad + 0.5) / (n_good + n_bad + 1)
            errors = np.abs(in_good / n_good - in_bad / n_bad) / np.sqrt(np.maximum(share * (1 - share), 1e-6) * (1 / n_good + 1 / n_bad))
            most = np.maximum(most, errors)
    return np.minimum(1, most / FULL_ERRORS) ** FALL


class ViewFit:
    """A logistic regression on slots of such values with an L2 penalty, by 120 steps of Adagrad over the labelled rows."""

    def __init__(self, examples: Examples, labels: np.ndarray, values: np.ndarray):
        self.use, self.size, self.values = labels >= 0, values.size, np.append(values, 1)
        self.slots, self.rows, self.n_rows = examples.slots, examples.rows, examples.n  # shared by all fits; rows that are not used have no error
        self.inner, self.squares = np.zeros(self.size + 1), np.full(self.size + 1, 1e-6)
        self.target, self.n = labels.astype(float), max(1, self.use.sum())
        self.penalty = np.full(self.size + 1, 1e-4)
        self.penalty[-1] = 0
        for _ in range(120):
            self.step(0)

    @property
    def weights(self) -> np.ndarray:
        return self.inner * self.values

    def step(self, others: np.ndarray | float) -> None:
        """One step, with the sums of gradients of ``others`` beside the labelled rows."""
        weights = self.weights
        errors = np.where(self.use, _sigmoid(np.bincount(self.rows, weights[self.slots], self.n_rows) + weights[-1]) - self.target, 0)
        gradient = (np.append(np.bincount(self.slots, errors[self.rows], self.size), errors.sum()) + others) * self.values / self.n + self.penalty * self.inner
        self.squares += gradient**2
        self.inner -= 0.3 * gradient / np.sqrt(self.squares)


def _calibrated(features: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Intercept and weights of a small logistic regression, by Newton steps."""
    x = np.column_stack([np.ones(len(features)), features])
    out = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ out)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(x.shape[1])
        out += np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * out)
    return out


@dataclass(frozen=True)
class CoTrained:
    """The two views' weights, their calibrations and how these combine."""

    text: np.ndarray
    page: np.ndarray
    text_fit: np.ndarray
    page_fit: np.ndarray
    both: np.ndarray

    def scores(self, text: Examples, page: Examples) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        one = self.text_fit[0] + self.text_fit[1] * text.margins(self.text)
        two = self.page_fit[0] + self.page_fit[1] * page.margins(self.page)
        return _sigmoid(one), _sigmoid(two), _sigmoid(self.both[0] + self.both[1] * one + self.both[2] * two)


def cotrain(text: Examples, page: Examples, kinds: np.ndarray, pool: DataFrame | None = None) -> CoTrained:
    """``kinds``: 1 good, 0 of low quality, 2 toxic; ``pool``: ``words`` and ``page`` of the unlabelled documents.

    The weights come from all labelled rows.  Scores are calibrated on each of ``FOLDS`` parts of them in turn, by a
    model that has not seen its labels.  With fewer than
    ten rows of either label no model is fitted and every score is 1: nothing is rejected.
    """
    labels = np.where(kinds == 2, 0, kinds)
    if min((labels == 1).sum(), (labels == 0).sum()) < 10:
        sure = np.array([30.0, 0.0])
        return CoTrained(np.zeros(SIZES[0] + 1), np.zeros(SIZES[1] + 1), sure, sure, np.array([30.0, 0.0, 0.0]))
    part = np.full(len(kinds), -1)
    for kind in (0, 1, 2):
        of = np.flatnonzero(kinds == kind)
        part[of] = np.arange(of.size) % FOLDS
    views, known = (text, page), part >= 0
    *folds, whole = _rounds(views, [*(np.where(part == k, -1, kinds) for k in range(FOLDS)), kinds], pool)
    margins = []
    for v, view in enumerate(views):
        margin = np.zeros(len(kinds))
        for k, model in enumerate(folds):
            margin[part == k] = view.margins(model[v])[part == k]
        margins.append(margin[known])
    target = labels[known].astype(float)
    fits = [_calibrated(m, target) for m in margins]
    both = _calibrated(np.column_stack([f[0] + f[1] * m for f, m in zip(fits, margins)]), target)
    return CoTrained(whole[0].astype(np.float32), whole[1], fits[0], fits[1], both)


def _rounds(views: tuple[Examples, Examples], fitted_on: list[np.ndarray], pool: DataFrame | None) -> list[list[np.ndarray]]:
    """Both views' weights after all rounds, for each choice of labelled rows.

    The rounds are the last choice's: it judges the unlabelled documents, counts them and sums them up.  The other choices
    take the steps of its last round.
    """

    def fitted(kinds: np.ndarray, more: list | None) -> list[ViewFit]:
        labels = np.where(kinds == 2, 0, kinds)
        values = slot_values(views[0], kinds, SIZES[0], more[0] if more else None), np.ones(SIZES[1])
        return [ViewFit(view, labels, v) for view, v in zip(views, values)]

    def stepped(model: list[ViewFit], sums: list) -> None:
        for view, others in zip(model, sums):
            view.step(others)

    *others, own = fitted_on
    model, counted, steps = fitted(own, None), None, []
    for _ in range(ROUNDS if pool is not None else 0):
        judges = [[view.weights for view in model]]
        seen = _pool_sums(pool, judges, None)[0]
        if not any(side[1] for view in seen for side in view):
            break
        model, counted, steps = fitted(own, seen), seen, []
        for _ in range(POOL_STEPS):
            steps.append(_pool_sums(pool, judges, [[view.weights for view in model]])[0])
            stepped(model, steps[-1])
    weights = []
    for kinds in others:
        other = fitted(kinds, counted)
        for sums in steps:
            stepped(other, sums)
        weights.append([view.weights for view in other])
    return [*weights, [view.weights for view in model]]


def _pool_sums(pool: DataFrame, judges: list, weights: list | None) -> list:
    """Over the documents of ``pool`` that a view of ``judges`` is sure of, sums for the other view, by model and view.

    Without ``weights``: for the bad and for the good ones, how many have each slot and how many
    there are.  Else the gradient at ``weights``, intercept last.
    """
    sides, widths = 1 if weights else 2, [size + 1 for size in SIZES]
    shape = (len(judges), sides, sum(widths))
    judges, weights = ([[w.astype(np.float32) for w in m] for m in x] if x else None for x in (judges, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(shape)
        for batch in batches:
            views = [Examples([_unpacked(x) for x in batch.column(c).to_pylist()]) for c in ("words", "page")]
            for m, judge in enumerate(judges):
                sure = [_sigmoid(view.margins(w)) for view, w in zip(views, judge)]
                for v, view in enumerate(views):
                    p, low = sure[1 - v], v * widths[0]
                    for side, chosen in enumerate((p <= 1 - SURE, p >= SURE)):
                        of = np.where(chosen, 1.0 if weights is None else _sigmoid(view.margins(weights[m][v])) - side, 0)
                        part = sums[m, side if sides == 2 else 0, low : low + widths[v]]
                        part += np.append(np.bincount(view.slots, of[view.rows], SIZES[v]), of.sum())
        flat = sums.ravel()
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(flat[at])], ["at", "value"])

    # A task gives at most a few MB; no more tasks than cores, so this does not grow with the documents.
    tasks = pool.select("words", "page").coalesce(pool.sparkSession.sparkContext.defaultParallelism)
    found = tasks.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    sums = np.zeros(int(np.prod(shape)))
    sums[found.column("at").to_numpy()] = found.column("value").to_numpy()
    split = [[np.split(side, [widths[0]]) for side in model] for model in sums.reshape(shape)]
    if weights:
        return [model[0] for model in split]
    return [[[(side[v][:-1], side[v][-1]) for side in model] for v in range(2)] for model in split]


def _slot_lists(batch: pa.RecordBatch) -> tuple[list[np.ndarray], list[np.ndarray]]:
    text, source, lang, n_chars = (batch.column(c).to_pylist() for c in ("text", "source", "lang", "n_chars"))
    return [text_slots(t.encode() if t else None) for t in text], [page_slots(*x) for x in zip(source, lang, n_chars)]


def _packed(slots: np.ndarray) -> bytes:
    """Sorted slots in two bytes each, after the number of those below 2 ** 16 in four."""
    slots = np.sort(slots)
    return np.searchsorted(slots, 1 << 16).astype("<u4").tobytes() + (slots & 0xFFFF).astype("<u2").tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    slots = np.frombuffer(packed, "<u2", offset=4).astype(np.int64)
    slots[int.from_bytes(packed[:4], "little") :] += 1 << 16
    return slots


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [hashlib.blake2b((t or "").encode(), digest_size=16).digest() for t in batch.column("text").to_pylist()]
        packed = [[_packed(x) for x in v] for v in _slot_lists(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.binary()) for x in (digests, *packed))], ["doc_id", "digest", "words", "page"])


def fit(documents: DataFrame, labels: DataFrame) -> CoTrained:
    """Co-train on ``labels`` (``doc_id``, ``quality``, ``toxic``): good is quality 1 and toxic 0.

    Labels with nulls or of unknown documents are not used; of several labels of a document
    toxic wins, then low quality.  Of rows that repeat a labelled ``doc_id`` the one with the smallest text digest is
    fitted on.  Documents whose label is not drawn are unlabelled ones, as are rows without an id; each such row counts.

    Slot lists are written where they are made and never shuffled: only ids meet the labels, and the ids drawn, a
    bounded number, go to the lists.
    """
    spark = documents.sparkSession
    small_batches(spark)
    kind = F.when(F.col("toxic") != 0, F.lit(2)).otherwise((F.col("quality") == 1).cast("int"))
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").dropna().groupBy("doc_id")
    known = told.agg(F.when(F.max(kind) == 2, F.lit(2)).otherwise(F.min(kind)).alias("kind"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang", F.col("n_chars").cast("long").alias("n_chars"))
    slots = spread(rows, "doc_id").mapInArrow(_described, "doc_id long, digest binary, words binary, page binary")
    found = stored(slots, "slots")
    # Bounded by a parameter, some hundred kB.
    drawn = found.select("doc_id").distinct().join(known, "doc_id").orderBy(F.xxhash64("doc_id", F.lit(6)), "doc_id").limit(MAX_LABELLED)
    chosen = F.broadcast(stored(drawn, "drawn"))
    first = F.min(F.struct("digest", "page", "words")).alias("d")
    fitted = found.join(chosen, "doc_id").groupBy("doc_id", "kind").agg(first).select("doc_id", "kind", "d.words", "d.page").toArrow().sort_by("doc_id")
    text, page = (Examples([_unpacked(x) for x in fitted.column(c).to_pylist()]) for c in ("words", "page"))
    return cotrain(text, page, fitted.column("kind").to_numpy(), found.join(chosen, "doc_id", "left_anti"))


def score(documents: DataFrame, model: CoTrained) -> DataFrame:
    """``documents`` with ``text_score``, ``page_score``, ``quality_score`` and ``kept``.

    Null and empty texts have no words; null metadata is a value of its own; repeated rows
    score alike; no rows give none; columns of these names are replaced, others pass through.
    """
    small_batches(documents.sparkSession)
    added = [c.split()[0] for c in SCORES.split(", ")]
    documents = documents.drop(*[c for c in documents.columns if c.lower() in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, pages = _slot_lists(batch)
            text, page, both = model.scores(Examples(words), Examples(pages))
            columns = [*batch.columns, pa.array(text), pa.array(page), pa.array(both), pa.array(both >= THRESHOLD)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *added])

    schema = StructType(list(documents.schema.fields))
    for field in SCORES.split(", "):
        schema = schema.add(*field.split())
    return spread(documents, "doc_id").mapInArrow(run, schema)
