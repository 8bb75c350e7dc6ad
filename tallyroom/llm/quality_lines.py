"""Quality rules by labelling lines: a linear-chain CRF marks content and boilerplate.

Every line with a word becomes a set of categorical features (symbols, capitals, separators,
repetition, length, shape). ``train_lines`` fits the weights of a two-label chain on a
bounded sample of labelled documents, ``label_lines`` decodes each document by Viterbi, and
the share of words that stand in content lines decides whether the document stays.

Labels are per document, lines have none. So a first per-line model learns from the
inherited labels; then the lines of a bad document that this model finds bad become
boilerplate, all others content; on these chains the CRF is fitted.

Beside the verdict every document gets plain measures of the whole text; a text of under
``MIN_WORDS`` words or with over ``MAX_REPEAT_PERCENT`` percent repeated words fails them.

Defined results: a null text is one without words, so it fails; a text whose lines are all
empty likewise; repeated rows and ids are judged each for itself, and of
rows that share an id only one, with the least features, trains; a null id stays null; long texts
are decoded whole; an empty table gives no rows. Without labelled rows of both kinds there is no model, and only
the plain measures decide. A document with contradicting labels trains nothing. Columns of
other names are never read, so clashing names cannot matter.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, slices, text_bytes, utf8

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
#: Share of words in content lines from which a document stays.
MIN_CONTENT_SHARE = 0.5
#: Bounds of the training sample: labelled documents per label, lines of one document.
SAMPLE_DOCS = 2000
SAMPLE_LINES = 512

CONTENT, BOILERPLATE = 0, 1

_SYMBOLS = b"#*$%&|<>"
_TERMINAL = tuple(b".?!\"')") + (0x85,)

#: Upper limits of the classes of each feature; a value above the last is a class more.
FEATURES: dict[str, tuple[float, ...]] = {
    "symbols per word": (0.0, 0.05, 0.3),
    "bars per word": (0.0, 0.1, 0.4),
    "exclamation marks per word": (0.0, 0.1, 0.5),
    "capital share of Latin letters": (0.1, 0.3, 0.6),
    "digit share": (0.0, 0.1, 0.3),
    "words": (2, 5, 20, 60),
    "mean word length": (2.5, 4.0, 9.0),
    "words equal to the one before": (0.0, 0.1, 0.4),
    "distinct share of words": (0.2, 0.5, 0.8),
    "equal to an earlier line": (0.5,),
    "ends like a sentence": (0.5,),
    "markup": (0.5,),
}
_SIZES = [len(limits) + 1 for limits in FEATURES.values()]
OFFSETS = np.concatenate([[0], np.cumsum(_SIZES)[:-1]])
N_FEATURES = int(sum(_SIZES))
_MARKUP = re.compile(rb"</?[a-zA-Z][^>]*>|https?://|\{[^}]*\}")
_CAPITALS = bytes(range(0x41, 0x5B))
_LETTERS = _CAPITALS + bytes(range(0x61, 0x7B))
_DIGITS = bytes(range(0x30, 0x3A))
#: White space, and the bytes of UTF-8 that continue a code point.
_NO_START = b" " + bytes(range(0x09, 0x0E)) + bytes(range(0x80, 0xC0))


@dataclass
class LineModel:
    """``line``: weight of each feature for boilerplate over content; ``step[a][b]``: weight
    of label b after a; ``first``: of a first line that is boilerplate."""

    line: np.ndarray = field(default_factory=lambda: np.zeros(N_FEATURES))
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    first: float = 0.0
    trained: bool = False


def _count(text: bytes, kinds: bytes) -> int:
    return len(text) - len(text.translate(None, kinds))


def _word_chars(text: bytes) -> int:
    """Code points in words."""
    return len(text.translate(None, _NO_START))


def _line_features(line: bytes, words: list[bytes], again: bool) -> list[int]:
    n = len(words)
    chars = _word_chars(line)
    end = line.rstrip()[-1:]
    values = (
        sum(line.count(s) for s in _SYMBOLS) / n,
        line.count(b"|") / n,
        line.count(b"!") / n,
        _count(line, _CAPITALS) / (_count(line, _LETTERS) or 1),
        _count(line, _DIGITS) / chars,
        n,
        chars / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        len(set(words)) / n,
        again,
        end != b"" and end[0] in _TERMINAL,
        _MARKUP.search(line) is not None,
    )
    out = []
    for offset, limits, value in zip(OFFSETS.tolist(), FEATURES.values(), values, strict=True):
        k = 0
        while k < len(limits) and value > limits[k]:
            k += 1
        out.append(offset + k)
    return out


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words in windows that occur twice or more, the first occurrence included.

    Windows are compared exactly, without building them: pairs of adjacent codes are
    numbered by sorting, then pairs of pairs, and so on.
    """
    n = len(words)
    if n <= window:
        return 0
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    if len(numbers) == n:
        return 0
    ranks, width = codes, 1
    while width < window:
        add = min(width, window - width)
        # The last ``add`` words of the longer window, as a code of their own width.
        tail = ranks[width:] if add == width else codes[width:]
        add = width if add == width else 1
        size = n - width - add + 1
        _, ranks = np.unique(ranks[:size] * np.int64(n + 1) + tail[:size], return_inverse=True)
        width += add
    twice = np.bincount(ranks)[ranks] > 1
    if not twice.any():
        return 0
    edges = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges)[:n] > 0).sum())


@dataclass
class Measured:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    line_words: list[int]
    features: list[list[int]]

    @property
    def failed(self) -> bool:
        return (self.n_words < MIN_WORDS
                or 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words)


def measure(text: bytes) -> Measured:
    words: list[bytes] = []
    counts, features = [], []
    seen: set[bytes] = set()
    repeats = 0
    for line in text.split(b"\n"):
        own = line.split()
        if not own:
            continue
        again = line in seen
        seen.add(line)
        repeats += again
        words += own
        counts.append(len(own))
        features.append(_line_features(line, own, again))
    return Measured(len(words), _word_chars(text), sum(text.count(s) for s in _SYMBOLS), repeats,
                    repeated_words(words), counts, features)


def viterbi(scores: list[float], model: LineModel) -> list[int]:
    """The best labels of a chain; ``scores``: of boilerplate over content, line by line.
    Of two equally good the one with content."""
    if not scores:
        return []
    (cc, cb), (bc, bb) = model.step.tolist()
    content, other = 0.0, model.first + scores[0]
    back = []
    for score in scores[1:]:
        stay, turn = content + cc, other + bc
        enter, remain = content + cb, other + bb
        back.append((turn > stay, remain > enter))
        content, other = max(stay, turn), max(enter, remain) + score
    label = int(other > content)
    labels = [label]
    for from_other in reversed(back):
        label = int(from_other[label])
        labels.append(label)
    return labels[::-1]


def _decode(m: Measured, model: LineModel) -> list[int]:
    line = model.line
    return viterbi([float(line[f].sum()) for f in m.features], model)


def _passes(m: Measured, labels: list[int], model: LineModel, min_share: float) -> bool:
    if m.failed:
        return False
    content = sum(n for n, label in zip(m.line_words, labels, strict=True) if label == CONTENT)
    return not model.trained or content >= min_share * m.n_words


def label_lines(df: DataFrame, model: LineModel, id_col: str = "doc_id", text_col: str = "text",
                min_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """Per document: id, the measures, base_failed, kept, content_words and the label of
    each line with a word (true: boilerplate). Map-only; the model is a few numbers."""
    schema = ("id bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
              "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, "
              "content_words bigint, boilerplate array<boolean>")

    def run(batches):
        import pyarrow as pa

        for keys, texts in slices(batches):
            rows = []
            for key, text in zip(keys, texts, strict=True):
                m = measure(text)
                labels = _decode(m, model)
                content = sum(n for n, b in zip(m.line_words, labels, strict=True) if not b)
                rows.append((key, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines,
                             m.n_repeat_words, m.failed, _passes(m, labels, model, min_share),
                             content, [bool(x) for x in labels]))
            kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.int64(), pa.list_(pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                names=[f.split()[0] for f in schema.split(", ")])

    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), utf8(text_col).alias("text"))
    return bounded(rows).mapInArrow(run, schema)


def keep_good(df: DataFrame, model: LineModel, text_col: str = "text",
              min_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """The rows of ``df``, all columns, whose documents pass."""
    place = df.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = []
            for text in text_bytes(batch.column(place)):
                m = measure(text)
                keep.append(_passes(m, _decode(m, model), model, min_share))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return bounded(df).mapInArrow(run, df.schema)


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
            bad: int, sample_docs: int) -> list[tuple[int, list[np.ndarray]]]:
    """(label, feature numbers of the lines) of a bounded sample, chosen by hash of the id."""
    known = (labels.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                           F.col(f"`{label_col}`").alias("label"))
             .where("id is not null and label is not null").groupBy("id")
             .agg(F.min("label").alias("label"), F.max("label").alias("most"))
             .where("label = most"))
    picked = [known.where(kind).orderBy(F.xxhash64("id"), "id").limit(sample_docs)
              for kind in (F.col("label") == bad, F.col("label") != bad)]
    # At most twice sample_docs ids: small enough to send everywhere.
    ids = picked[0].unionByName(picked[1]).select("id", (F.col("label") == bad).alias("bad"))
    rows = (docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                        utf8(text_col).alias("text"))
            .join(F.broadcast(ids), "id").select("id", "bad", "text"))

    def run(batches):
        import pyarrow as pa

        for keys, flags, texts in slices(batches):
            out = [(key, flag, m.features)
                   for key, flag, m in zip(keys, flags, map(measure, texts), strict=True)
                   if 0 < len(m.features) <= SAMPLE_LINES]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _, _ in out], pa.int64()),
                 pa.array([a for _, a, _ in out], pa.bool_()),
                 pa.array([np.asarray(b, np.uint8).tobytes() for _, _, b in out], pa.binary())],
                names=["id", "bad", "features"])

    # Of rows that share an id the least features count; tasks reduce them before the shuffle.
    least = (bounded(rows).mapInArrow(run, "id bigint, bad boolean, features binary")
             .groupBy("id", "bad").agg(F.min("features").alias("features")))
    got = sorted((int(r.bad), bytes(r.features)) for r in least.collect())
    return [(bad_, np.frombuffer(f, np.uint8).reshape(-1, len(FEATURES)).astype(np.int64))
            for bad_, f in got]


def _ascend(params: np.ndarray, gradient, steps: int, rate: float = 0.1) -> np.ndarray:
    """Adam; the gradient is of what is to be made large."""
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, steps + 1):
        g = gradient(params)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        params = params + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return params


def _line_model(lines: np.ndarray, bad: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression of the line label on its features."""
    def gradient(w):
        p = 1 / (1 + np.exp(-w[lines].sum(1)))
        error = weight * (bad - p)
        g = np.zeros(N_FEATURES)
        for k in range(lines.shape[1]):
            g += np.bincount(lines[:, k], error, N_FEATURES)
        return g / weight.sum() - 1e-4 * w

    return _ascend(np.zeros(N_FEATURES), gradient, 300)


def fit_chain(chains: list[np.ndarray], labels: list[np.ndarray], weights: np.ndarray,
              steps: int = 120) -> LineModel:
    """Maximise the conditional likelihood of the labels by forward and backward sums.

    Chains run side by side, longest first, so a position is one array operation.
    """
    order = sorted(range(len(chains)), key=lambda i: -len(chains[i]))
    chains, labels = [chains[i] for i in order], [labels[i] for i in order]
    weights = weights[order]
    lengths = np.array([len(c) for c in chains])
    live = [int((lengths > t).sum()) for t in range(lengths[0])]
    flat = [np.stack([chains[i][t] for i in range(n)]) for t, n in enumerate(live)]
    truth = [np.array([labels[i][t] for i in range(n)]) for t, n in enumerate(live)]
    total = weights.sum()

    def gradient(params):
        w, step, first = params[:N_FEATURES], params[N_FEATURES:-1].reshape(2, 2), params[-1]
        emit = [np.stack([np.zeros(n), w[f].sum(1)], 1) for f, n in zip(flat, live, strict=True)]
        alpha = [emit[0] + np.array([0.0, first])]
        for t in range(1, len(live)):
            before = alpha[-1][:live[t]]
            alpha.append(np.logaddexp(before[:, :1] + step[0], before[:, 1:] + step[1]) + emit[t])
        norm = np.zeros(len(chains))
        beta = np.zeros((live[-1], 2))
        g = np.zeros_like(params)
        for t in range(len(live) - 1, -1, -1):
            full = np.zeros((live[t], 2))
            full[:len(beta)] = beta
            beta = full
            ends = slice(live[t + 1] if t + 1 < len(live) else 0, live[t])
            norm[ends] = np.logaddexp(alpha[t][ends, 0], alpha[t][ends, 1])
            n = live[t]
            marginal = np.exp(alpha[t] + beta - norm[:n, None])
            error = weights[:n] * ((truth[t] == 1) - marginal[:, 1])
            for k in range(flat[t].shape[1]):
                g[:N_FEATURES] += np.bincount(flat[t][:, k], error, N_FEATURES)
            if t == 0:
                g[-1] += error.sum()
                break
            follow = emit[t] + beta
            pair = np.exp(alpha[t - 1][:n, :, None] + step + follow[:, None, :]
                          - norm[:n, None, None])
            seen = np.zeros((n, 2, 2))
            seen[np.arange(n), truth[t - 1][:n], truth[t]] = 1
            g[N_FEATURES:-1] += ((seen - pair) * weights[:n, None, None]).sum(0).ravel()
            beta = np.logaddexp(step[:, 0] + follow[:, :1], step[:, 1] + follow[:, 1:])
        return g / total - 1e-3 * params

    params = _ascend(np.zeros(N_FEATURES + 5), gradient, steps)
    return LineModel(params[:N_FEATURES], params[N_FEATURES:-1].reshape(2, 2),
                     float(params[-1]), True)


def train_lines(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "quality", bad: int = 0,
                sample_docs: int = SAMPLE_DOCS) -> LineModel:
    """The line model, from at most ``sample_docs`` documents of each label."""
    sample = _sample(docs, labels, id_col, text_col, label_col, bad, sample_docs)
    n_bad = sum(b for b, _ in sample)
    if not 0 < n_bad < len(sample):
        return LineModel()
    inherited = np.concatenate([np.full(len(c), b) for b, c in sample])
    lines = np.concatenate([c for _, c in sample])
    balance = len(inherited) / 2 / np.maximum(1, np.bincount(inherited, minlength=2))
    first = _line_model(lines, inherited, balance[inherited])
    chains, truth, weights = [], [], []
    for is_bad, chain in sample:
        marks = (first[chain].sum(1) > 0).astype(np.int64) if is_bad else np.zeros(
            len(chain), np.int64)
        if is_bad and not marks.any():
            continue
        chains.append(chain)
        truth.append(marks)
        weights.append(1.0 / len(chain) * (len(sample) / 2 / (n_bad if is_bad else
                                                             len(sample) - n_bad)))
    return fit_chain(chains, truth, np.array(weights))
