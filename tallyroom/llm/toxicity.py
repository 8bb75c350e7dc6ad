"""Toxicity by compression distance: two zstandard dictionaries, windows, calibrated gaps.

One dictionary is trained on ordinary text, one on toxic text. A text is cut, at spaces,
into windows; each window is compressed with the ordinary dictionary and with the toxic one
on top of it, and the gap of the two lengths says how much the toxic vocabulary explains.

Training (``train``), on a bounded sample of labelled documents:

* Dictionary content is chosen by contrast. A word counts once per distinct pair of neighbours,
  so copies of a document add nothing; the toxic dictionary takes the words that stand in
  significantly more toxic than ordinary documents, the ordinary one the most common others.
  (The trainer inside zstandard fills a dictionary with the most frequent strings, which are
  the same in both kinds of text; measured on held-out documents it told them apart hardly
  better than chance.)
* In three folds, with dictionaries made from the other two, the gaps of toxic and ordinary text give every
  gap a log-likelihood ratio, made monotone, and a logistic curve turns the sum over the windows of a
  document into a probability.

Only the text is an input of a score. Defined results: a null text is an empty one; a text
without windows scores the prior; without labelled documents of both kinds every score is 0; documents
with contradicting labels train nothing; repeated rows and ids are scored each for itself,
and of rows that share an id the least text trains;
long texts are scored whole, window by window; an empty table gives no rows. Columns of
other names are never read, so clashing names cannot matter.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, slices, text_bytes, utf8

WINDOW = 64
ORDINARY_BYTES = 32 << 10
TOXIC_BYTES = 4 << 10
#: Standard errors by which a word must be more frequent in toxic documents, and least count.
CONTRAST = 5.0
LEAST_COUNT = 3
#: Gaps beyond this many bytes count as this.
MAX_GAP = 20
THRESHOLD = 0.3
#: Bounds of the training sample: documents per label, bytes of one document and of all of a label.
SAMPLE_DOCS = 3000
SAMPLE_BYTES = 64 << 10
SAMPLE_TOTAL = 48 << 20


@dataclass
class ToxicityModel:
    ordinary: bytes = b""
    toxic: bytes = b""
    #: Log-likelihood ratio of a window by its gap, from -MAX_GAP to MAX_GAP.
    ratios: np.ndarray = field(default_factory=lambda: np.zeros(2 * MAX_GAP + 1))
    slope: float = 0.0
    bias: float = -math.inf
    trained: bool = False


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The lower-cased text in pieces of ``size`` bytes or somewhat more, cut behind a space
    if one follows soon."""
    text = text.lower()
    out, start, n = [], 0, len(text)
    while start < n:
        stop = start + size
        if stop < n:
            space = text.find(b" ", stop, stop + size)
            stop = space + 1 if space >= 0 else stop
        out.append(text[start:stop])
        start = stop
    return out


class Gaps:
    """Compressors of the two dictionaries."""

    def __init__(self, model: ToxicityModel):
        self.compress = [self._compressor(d) for d in (model.ordinary,
                                                       model.toxic + model.ordinary)]

    @staticmethod
    def _compressor(content: bytes):
        import zstandard as zs

        params = zs.ZstdCompressionParameters.from_level(
            3, min_match=4, strategy=zs.STRATEGY_LAZY2, write_content_size=False,
            write_dict_id=False, write_checksum=False)
        dictionary = zs.ZstdCompressionDict(content or b" ", dict_type=zs.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=params)
        return zs.ZstdCompressor(dict_data=dictionary, compression_params=params).compress

    def counts(self, text: bytes) -> np.ndarray:
        """How many windows have each gap."""
        plain, toxic = self.compress
        gaps = [len(plain(w)) - len(toxic(w)) for w in windows(text)]
        return np.bincount(np.clip(np.array(gaps, np.int64), -MAX_GAP, MAX_GAP) + MAX_GAP,
                           minlength=2 * MAX_GAP + 1)


def score_counts(counts: np.ndarray, model: ToxicityModel) -> float:
    if not model.trained:
        return 0.0
    z = model.bias + model.slope * float(counts @ model.ratios)
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def score_toxicity(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id",
                   text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per document: id, score, predicted, n_windows and the mean gap. Map-only; the
    model (some 40 KB, of fixed size) goes with the tasks."""

    def run(batches):
        import pyarrow as pa

        gaps = Gaps(model)
        steps = np.arange(-MAX_GAP, MAX_GAP + 1)
        for keys, texts in slices(batches):
            counts = [gaps.counts(t) for t in texts]
            n = [int(c.sum()) for c in counts]
            scores = [score_counts(c, model) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32()),
                 pa.array(n, pa.int64()),
                 pa.array([float(c @ steps) / max(1, k) for c, k in zip(counts, n, strict=True)],
                          pa.float64())],
                names=["id", "score", "predicted", "n_windows", "mean_gap"])

    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), utf8(text_col).alias("text"))
    return bounded(rows).mapInArrow(run, "id bigint, score double, predicted int, n_windows bigint, "
                                "mean_gap double")


def drop_toxic(df: DataFrame, model: ToxicityModel, text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df``, all columns, that score below the threshold."""
    place = df.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        gaps = Gaps(model)
        for batch in batches:
            keep = [score_counts(gaps.counts(t), model) < threshold
                    for t in text_bytes(batch.column(place))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return bounded(df).mapInArrow(run, df.schema)


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
            usable: Column | None, sample_docs: int) -> tuple[list[tuple[int, bytes]], float]:
    """Labelled texts chosen by hash of the id, in that order, and the share of toxic labels."""
    known = (labels.where(F.lit(True) if usable is None else usable)
             .select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                     F.col(f"`{label_col}`").alias("label"))
             .where("id is not null and label in (0, 1)").groupBy("id")
             .agg(F.min("label").alias("label"), F.max("label").alias("most"))
             .where("label = most"))
    share = known.agg(F.avg("label")).first()[0] or 0.0
    order = F.xxhash64("id")
    picked = [known.where(F.col("label") == k).orderBy(order, "id").limit(sample_docs)
              for k in (0, 1)]
    # At most twice sample_docs ids: small enough to send everywhere.
    ids = picked[0].unionByName(picked[1]).select("id", "label", order.alias("place"))
    rows = (docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                        utf8(text_col).alias("text"))
            .where(F.length("text") <= SAMPLE_BYTES).join(F.broadcast(ids), "id")
            # Of rows that share an id the least text counts; tasks reduce them before the shuffle.
            .groupBy("place", "id", "label").agg(F.min("text").alias("text")))
    # At most sample_docs rows of a label stand in one window.
    held = F.sum(F.length("text")).over(Window.partitionBy("label").orderBy("place", "id"))
    rows = rows.withColumn("held", held).where(F.col("held") <= SAMPLE_TOTAL).drop("held").collect()
    return [(r.label, bytes(r.text)) for r in sorted(rows, key=lambda r: r[:3])], share


def _document_counts(texts: list[bytes]) -> Counter:
    """In how many texts a word stands between neighbours that it has not had before.

    As arrays of word numbers, some 40 bytes a word: each word with its neighbours counts for the
    first text that holds the three.
    """
    names: dict[bytes, int] = {b"": 0}
    pieces, gap = [np.zeros(1, np.int32)], np.zeros(1, np.int32)
    for text in texts:
        words = text.lower().split()
        pieces += [np.fromiter((names.setdefault(w, len(names)) for w in words), np.int32,
                               len(words)), gap]
    words = np.concatenate(pieces)
    # A gap ends each text, and no word has its number.
    text_of = np.cumsum(words == 0, dtype=np.int32)[1:-1]
    before, word, after = words[:-2], words[1:-1], words[2:]
    order = np.lexsort((after, before, word))
    changes = np.zeros(len(order), bool)
    changes[:1] = True
    for part in (before, word, after):
        part = part[order]
        changes[1:] |= part[1:] != part[:-1]
    first = order[changes]
    first = first[word[first] > 0]
    pairs = np.unique(word[first].astype(np.int64) * (len(texts) + 1) + text_of[first])
    found = np.bincount(pairs // (len(texts) + 1), minlength=len(names)).tolist()
    return Counter({w: n for w, n in zip(names, found, strict=True) if n})


def _contents(ordinary: list[bytes], toxic: list[bytes]) -> tuple[bytes, bytes]:
    """The two dictionaries' content; the most telling words come last, where they are
    cheapest to refer to."""
    a, b = _document_counts(toxic), _document_counts(ordinary)
    na, nb = len(toxic), len(ordinary)

    def contrast(word: bytes) -> float:
        x, y = a[word], b[word]
        p = (x + y) / (na + nb)
        return (x / na - y / nb) / math.sqrt(p * (1 - p) * (1 / na + 1 / nb) + 1e-12)

    def fill(words, limit):
        out, size = [], 0
        for w in words:
            if size + len(w) + 1 > limit:
                break
            out.append(w)
            size += len(w) + 1
        return b" " + b" ".join(out[::-1]) + b" " if out else b""

    telling = sorted(((-c, w) for w, x in a.items()
                      if x >= LEAST_COUNT and (c := contrast(w)) >= CONTRAST))
    marked = {w for _, w in telling}
    common = sorted((-n, w) for w, n in b.items() if w not in marked)
    return fill((w for _, w in common), ORDINARY_BYTES), fill((w for _, w in telling), TOXIC_BYTES)


def _monotone(ratios: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The closest rising sequence (pooling neighbours that fall)."""
    blocks: list[list[float]] = []
    for r, w in zip(ratios.tolist(), weights.tolist(), strict=True):
        blocks.append([r, w, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            r2, w2, n2 = blocks.pop()
            r1, w1, n1 = blocks.pop()
            blocks.append([(r1 * w1 + r2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), r) for r, _, n in blocks])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and bias by Newton's method, with a little shrinkage."""
    scale = max(1e-9, float(np.abs(x).max()))
    design = np.stack([x / scale, np.ones_like(x)], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (weight * (y - p)) - 1e-3 * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curve, gradient), -5, 5)
    return float(beta[0] / scale), float(beta[1])


def fit(sample: list[tuple[int, bytes]], share: float) -> ToxicityModel:
    """The model from labelled texts; ``share``: of toxic documents among all."""
    texts = {k: [t for label, t in sample if label == k] for k in (0, 1)}
    if not texts[0] or not texts[1]:
        return ToxicityModel()
    # Three folds: each is measured with dictionaries made from the two others.
    folds = min(3, *map(len, texts.values()))
    measured: dict[int, list[np.ndarray]] = {0: [], 1: []}
    for fold in range(folds):
        rest = [[t for i, t in enumerate(texts[k]) if folds == 1 or i % folds != fold]
                for k in (0, 1)]
        gaps = Gaps(ToxicityModel(*_contents(*rest)))
        for k in (0, 1):
            measured[k] += [gaps.counts(t) for t in texts[k][fold::folds]]
    counts = {k: np.array(v) for k, v in measured.items()}
    model = ToxicityModel(*_contents(texts[0], texts[1]))
    totals = {k: c.sum(0) + 0.5 for k, c in counts.items()}
    ratios = np.log(totals[1] / totals[1].sum()) - np.log(totals[0] / totals[0].sum())
    model.ratios = _monotone(ratios, totals[0] + totals[1])
    x = np.concatenate([counts[0] @ model.ratios, counts[1] @ model.ratios])
    y = np.repeat([0.0, 1.0], [len(counts[0]), len(counts[1])])
    weight = np.where(y == 1, share * len(y) / len(counts[1]), (1 - share) * len(y) / len(counts[0]))
    model.slope, model.bias = _logistic(x, y, weight)
    model.trained = True
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", usable: Column | None = None,
          sample_docs: int = SAMPLE_DOCS) -> ToxicityModel:
    """Fit on at most ``sample_docs`` labelled documents of each kind; ``usable`` limits the
    labels that may be learned from."""
    return fit(*_sample(docs, labels, id_col, text_col, label_col, usable, sample_docs))
