"""Language-model scores by Brown classes: exchange clustering and a class bigram.

The probability of a text is the product over its tokens of
P(class | class before) * P(word | class), with additive smoothing on both. Tokens are the
words of the lower-cased text (A-Z only) and one end, which is also what comes before the
first word.

Exchange clustering moves one word at a time to the class that raises the likelihood of the
class bigram most. Every word of the corpus is clustered for itself:

* The start, on the driver: the ``CORE_WORDS`` most frequent words, each for itself, and ``ENDINGS`` groups
  of all others by their last two bytes, moved one by one until none moves.
* The known words, the ``FREQUENT_WORDS`` most frequent ones, move in rounds. The pairs of words
  are counted and merged once, dealt by word, and stay in storage; a round reads them with the classes as
  they are, which are one small array. The core and the groups move on the driver, the other known words in
  tasks: each moves its words block after block against its own copy of the class grid. The exact grid
  is counted anew between rounds. The rounds end with the first that adds less than
  ``LEAST_SHARE`` of all the likelihood gained so far, or loses; a round that loses is not kept. The
  rule does not depend on the size of anything.
* Every other word then leaves the group of its ending for its best class, given the words around
  it. Known words do not move again after that.

The grid of the model is exact: pairs of known words, of known and rare, and of rare words are
counted with the classes they ended in. Words that training did not see have the class of their
ending.

What is learned covers the whole training part: exact counts of every word (one shuffle of
words, counted in map tasks first), of what stands beside every word, class sizes. Pairs travel as
packed arrays, a row per task, kind and part, merged in the map tasks first. The pairs of the most
frequent words are dealt by the words beside them, so no part belongs to a hot word alone.
Rare words are named by 64-bit hashes; words of equal hash would move together. Only sizes fixed by
parameters go through the driver or a broadcast: the start, the grid, the classes of the
known words and these themselves, at most ``KNOWN_BYTES`` each, which the scoring tasks look up in place.
All other words of a text meet their count and class in joins by word; they are no hot keys, but for
words longer than that, whose rows adaptive execution splits.

Defined results: a null text is an empty one, its only token is the end; a null id learns and is
not held out; rows that share an id are scored each for itself; texts of any length are
scored whole; of words with equal counts the smaller bytes come first; an empty table gives no
rows; without training documents all counts are 0. Columns of other names are never read,
so clashing names cannot matter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import bounded, forgotten, removed, shuffles_dropped, slices, utf8, written

CORE_WORDS = 1024
ENDINGS = 256
CLASSES = 48
FREQUENT_WORDS = 1 << 17
#: Added to every count, one more word of each class standing for all unknown ones.
SMOOTHING = 0.1
#: Distinct words a counting task holds before it passes them on.
COUNTER_WORDS = 1 << 18
#: Tokens whose pairs a task counts together before it passes them on.
PAIR_TOKENS = 1 << 18
#: Longest word that is one of the known ones.
KNOWN_BYTES = 64
#: Rounds end when one adds less than this share of the likelihood gained so far.
LEAST_SHARE = 0.01
#: Words that choose by the same grid before it follows their moves: known and rare ones.
BLOCK = 64
RARE_BLOCK = 1024
#: Rare words whose neighbours a task spreads out at a time.
RARE_WORDS = 1 << 15
#: Pieces of the counted pairs for each task; a task holds one of them at a time.
PARTS = 3
#: Counted pairs a task holds before it merges them.
MERGE_ENTRIES = 1 << 23


@dataclass
class ClassModel:
    """Everything of fixed size; (word, n, cls) of the words that are not known are the frame ``rare``."""

    rare: DataFrame
    tokens: int
    distinct: int
    frequent: list[bytes]
    frequent_counts: np.ndarray
    end_count: int
    #: Classes of the frequent words, of the end, and of unseen words by their ending.
    frequent_classes: np.ndarray
    end_class: int
    endings: np.ndarray
    #: log10 P(class | class before).
    steps: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    smoothing: float = SMOOTHING

    @property
    def counts(self) -> DataFrame:
        """(word, n, cls) of all words; the null word is the end."""
        import pyarrow as pa

        known = pa.table({"word": pa.array([*self.frequent, None], pa.binary()),
                          "n": pa.array([*self.frequent_counts.tolist(), self.end_count], pa.int64()),
                          "cls": pa.array([*self.frequent_classes.tolist(), self.end_class], pa.int32())})
        return self.rare.unionByName(self.rare.sparkSession.createDataFrame(known))


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDINGS


class Endings(dict):
    """The group of the last two bytes of a word, worked out once each."""

    def __missing__(self, last: bytes) -> int:
        self[last] = group = ending(last)
        return group


def ending_column(word: str) -> Column:
    """``ending`` of a binary column."""
    last = F.expr(f"substring({word}, -2, 2)")
    return F.pmod(F.crc32(F.when(F.length(word) < 2, F.col(word)).otherwise(last)),
                  F.lit(ENDINGS)).cast("int")


def _texts(docs: DataFrame, text_col: str, learns: Column | None) -> DataFrame:
    rows = docs if learns is None else docs.where(learns)
    return rows.select(utf8(text_col).alias("text"))


def count_words(docs: DataFrame, text_col: str, learns: Column | None) -> DataFrame:
    """(word, n) over all training texts; the null word is the end."""
    def run(batches):
        import pyarrow as pa

        counts: Counter = Counter()
        ends = 0

        def rows(counter):
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counter.keys()), pa.binary()),
                 pa.array(list(counter.values()), pa.int64())], names=["word", "n"])

        for (texts,) in slices(batches):
            ends += len(texts)
            for text in texts:
                counts.update(text.lower().split())
                if len(counts) > COUNTER_WORDS:
                    yield rows(counts)
                    counts.clear()
        if counts:
            yield rows(counts)
        if ends:
            yield rows({None: ends})

    return (bounded(_texts(docs, text_col, learns)).mapInArrow(run, "word binary, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _xlogx(x: np.ndarray) -> np.ndarray:
    out = np.maximum(x, 1e-300)
    np.log(out, out)
    out *= x
    return out


def likelihood(grid: np.ndarray) -> float:
    return float(_xlogx(grid).sum() - 2 * _xlogx(grid.sum(1)).sum())


def _move_until_none(pairs: np.ndarray, right: np.ndarray, left: np.ndarray, of: np.ndarray,
                     grid: np.ndarray) -> None:
    """Move units one by one, most frequent first, to the class with the largest likelihood, until
    none moves; of equal classes the first. ``right`` and ``left`` count the classes after and before each
    unit, ``pairs`` the units among themselves. ``of``, ``grid`` and the counts change in place."""
    size, total = right.sum(1), grid.sum(1)
    order = np.argsort(-size, kind="stable")
    moved = 1
    while moved:
        moved = 0
        for w in order:
            if not size[w]:
                continue
            k, own = of[w], pairs[w, w]
            r, l_ = right[w].copy(), left[w].copy()
            r[k] -= own
            l_[k] -= own
            grid[k] -= r
            grid[:, k] -= l_
            grid[k, k] -= own
            total[k] -= size[w]
            base = _xlogx(grid)
            rows = _xlogx(grid + r) - base
            cols = _xlogx(grid + l_[:, None]) - base
            diagonal = np.diag(grid)
            gain = (rows.sum(1) - np.diag(rows) + cols.sum(0) - np.diag(cols)
                    + _xlogx(diagonal + r + l_ + own) - np.diag(base)
                    - 2 * (_xlogx(total + size[w]) - _xlogx(total)))
            j = int(np.argmax(gain))
            if gain[j] <= gain[k] + 1e-9:
                j = k
            grid[j] += r
            grid[:, j] += l_
            grid[j, j] += own
            total[j] += size[w]
            if j != k:
                of[w] = j
                moved += 1
                right[:, k] -= pairs[:, w]
                right[:, j] += pairs[:, w]
                left[:, k] -= pairs[w]
                left[:, j] += pairs[w]


def exchange(pairs: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """A class for every unit: dealt out by frequency, then moved until none moves."""
    n = len(pairs)
    classes = min(classes, n)
    of = np.empty(n, np.int64)
    of[np.argsort(-pairs.sum(0), kind="stable")] = np.arange(n) % classes
    member = np.zeros((n, classes))
    member[np.arange(n), of] = 1
    right = pairs @ member
    _move_until_none(pairs, right, pairs.T @ member, of, member.T @ right)
    return of


def _change(x: np.ndarray, level: np.ndarray, more: np.ndarray) -> np.ndarray:
    """x log x of ``x + more`` minus that of ``x``, which is ``level``; most of ``more`` is 0."""
    x, level, more = np.broadcast_arrays(x, level, more)
    out = np.zeros(more.shape)
    at = np.nonzero(more)
    out[at] = _xlogx((x[at] + more[at]).clip(0)) - level[at]
    return out


def gains(grid: np.ndarray, entries: np.ndarray, times: np.ndarray, first: np.ndarray,
          of: np.ndarray, own: np.ndarray) -> np.ndarray:
    """What the likelihood gains when one word alone goes to each class, [word, class].

    A word's entries start at ``first``: class c after it is c, before it K + c, and ``times``
    how often. ``own``: how often the word follows itself.
    """
    k, m = len(grid), len(of)
    total, diagonal, line = grid.sum(1), np.diag(grid), np.arange(m)
    f = _xlogx
    near, level = np.vstack([grid.T, grid]), f(grid)
    steps = f(near[entries] + times[:, None]) - np.vstack([level.T, level])[entries]
    put = np.add.reduceat(steps, first, 0)
    dense = np.zeros((m, 2 * k))
    dense[np.repeat(line, np.diff(np.r_[first, len(entries)])), entries] = times
    r, l_ = dense[:, :k], dense[:, k:]
    size = r.sum(1)
    row, col = grid[of], grid.T[of]
    base_row, base_col, base = level[of], level.T[of], np.diag(level)
    take = _change(row, base_row, -r) + _change(col, base_col, -l_)
    rk, lk, s = r[line, of][:, None], l_[line, of][:, None], own[:, None]
    # Cells where the old and the new class meet are counted by themselves.
    gain = (take.sum(1) - take[line, of])[:, None] - take
    gain += put - _change(diagonal, base, r) - _change(diagonal, base, l_)
    gain -= _change(col, base_col, rk) + _change(row, base_row, lk)
    gain += (f((diagonal[of][:, None] - rk - lk + s).clip(0)) - base[of][:, None]
             + _change(diagonal, base, r + l_ + s)
             + _change(row, base_row, lk - r - s) + _change(col, base_col, rk - l_ - s))
    old = total[of]
    sizes, same = np.unique(size, return_inverse=True)
    gain -= 2 * ((f((old - size).clip(0)) - f(old))[:, None]
                 + (f(total + sizes[:, None]) - f(total))[same])
    gain[line, of] = 0
    return gain


def move_words(grid: np.ndarray, near: np.ndarray, of: np.ndarray, own: np.ndarray,
               block: int = BLOCK) -> None:
    """Move words to their best classes against a grid that follows the moves.

    ``near``: [word, class after it; class before it]. The words of a block choose by the same grid;
    then their moves change it. ``of`` and ``grid`` change in place.
    """
    k = len(grid)
    least = 1e-6 + 1e-12 * abs(likelihood(grid))
    for lo in range(0, len(of), block):
        part = slice(lo, lo + block)
        line, entries = np.nonzero(near[part])
        first = np.searchsorted(line, np.arange(len(of[part])))
        gain = gains(grid, entries, near[part][line, entries], first, of[part], own[part])
        want = gain.argmax(1)
        at = np.flatnonzero(gain.max(1) > least)
        w, line = lo + at, np.arange(len(at))
        for sign, c in ((-1, of[w]), (1, want[at])):
            if sign > 0 and own[w].any():
                # A word that follows itself takes itself along.
                for side in (0, k):
                    near[w, side + of[w]] -= own[w]
                    near[w, side + c] += own[w]
            member = np.zeros((len(at), k))
            member[line, c] = sign
            grid += member.T @ near[w, :k] + near[w, k:].T @ member
            grid[np.diag_indices(k)] -= own[w] @ member
        of[w] = want[at]


def hashes(words: list[bytes]) -> np.ndarray:
    """The number of each word."""
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


class Units:
    """Numbers of the known words. Big units come first: the ``core`` most frequent words, the groups of
    rare words by their ending, and the end; then the other known words."""

    def __init__(self, known: list[bytes], core: int):
        self.core = min(core, len(known))
        self.end = self.core + ENDINGS
        self.big = self.end + 1
        self.count = len(known) + ENDINGS + 1
        self.of = {w: i if i < self.core else i + ENDINGS + 1 for i, w in enumerate(known)}
        #: The big unit that stands for each unit in the start.
        self.start = np.arange(self.count)
        self.start[self.big:] = [self.core + ending(w) for w in known[self.core:]]
        #: The unit of each known word, in their order.
        self.known = np.r_[np.arange(self.core), np.arange(self.big, self.count)]

    def rare(self, unit: np.ndarray) -> np.ndarray:
        """Whether a unit is a group of rare words."""
        return (unit >= self.core) & (unit < self.end)


# What the text pass counts, as packed rows of (kind, part, x, y, z, n).
_START, _BIG, _OWN, _RARE, _BOTH = range(5)
_KINDS = {_START: "q", _BIG: "q", _OWN: "q", _RARE: "qii", _BOTH: "qq"}
_PACKED = "kind int, part int, x binary, y binary, z binary, n binary"


def _merged(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows become one, with their sum; rows come out in order."""
    if not len(n):
        return columns, n
    if len(columns) == 1:
        order = np.argsort(columns[0], kind="stable")
    else:
        order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.zeros(len(n), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.add.reduceat(n[order], first)


def _rows(kind: int, parts: list[int], found: list[tuple[list[np.ndarray], np.ndarray]]):
    """Packed rows of one kind; sorted columns are stored by their steps, which compress well."""
    import pyarrow as pa

    packed = []
    for columns, n in found:
        row = [np.diff(c, prepend=c.dtype.type(0)).tobytes() for c in columns]
        packed.append(row + [None] * (3 - len(row)) + [n.astype(np.int64).tobytes()])
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(parts), pa.int32()), pa.array(parts, pa.int32()),
         *[pa.array([row[i] for row in packed], pa.binary()) for i in range(4)]],
        names=["kind", "part", "x", "y", "z", "n"])


def _unpacked(row: dict) -> tuple[list[np.ndarray], np.ndarray]:
    columns = [np.cumsum(np.frombuffer(row[c], t), dtype=t)
               for c, t in zip("xyz", _KINDS[row["kind"]], strict=False)]
    return columns, np.frombuffer(row["n"], np.int64)


def count_links(docs: DataFrame, text_col: str, learns: Column | None, units: Units,
                parts: int) -> DataFrame:
    """What follows what, counted once over all texts and merged by part: pairs of start units
    (_START) and of big units (_BIG), first * big + second; the neighbours of each other known word
    (_OWN): word * 2 count + unit after it, or + count + unit before it; those of each rare word
    (_RARE): hash, unit before * ENDINGS + its own group, unit after; and pairs of rare words (_BOTH)."""
    shared = docs.sparkSession.sparkContext.broadcast(units)

    def counted(line: np.ndarray, names: np.ndarray, dense: list[np.ndarray]):
        """Rows of all pairs of a piece, but for those that go to the dense counts."""
        u = shared.value
        a, b = line[:-1], line[1:]
        big = (a < u.big) & (b < u.big)
        for sums, code in zip(dense, (u.start[a] * u.big + u.start[b], a[big] * u.big + b[big]),
                              strict=True):
            sums += np.bincount(code, minlength=u.big ** 2)
        rare = np.flatnonzero(u.rare(line))
        both = np.flatnonzero(u.rare(a) & u.rare(b))
        own, back = a >= u.big, b >= u.big
        found = []
        code, n = np.unique(np.r_[a[own] * (2 * u.count) + b[own],
                                  b[back] * (2 * u.count) + u.count + a[back]], return_counts=True)
        found.append((_OWN, [code], n))
        beside = line[rare - 1] * ENDINGS + line[rare] - u.core
        found.append((_RARE, *_merged([names[rare], beside.astype(np.int32),
                                       line[rare + 1].astype(np.int32)], np.ones(len(rare), np.int64))))
        found.append((_BOTH, *_merged([names[both], names[both + 1]], np.ones(len(both), np.int64))))
        for kind, columns, n in found:
            yield from dealt(kind, columns, n)

    def dealt(kind: int, columns: list[np.ndarray], n: np.ndarray):
        if len(n):
            key = columns[0] // (2 * shared.value.count) if kind == _OWN else columns[0]
            of = (key % parts).astype(np.uint16 if parts < 1 << 16 else np.int64)
            order = np.argsort(of, kind="stable")
            ends = np.searchsorted(of[order], np.arange(parts + 1))
            columns, n = [c[order] for c in columns], n[order]
            full = np.flatnonzero(np.diff(ends)).tolist()
            yield _rows(kind, full, [([c[ends[p]:ends[p + 1]] for c in columns], n[ends[p]:ends[p + 1]])
                                     for p in full])

    def run(batches):
        u = shared.value
        find = u.of.get
        start, groups = np.array([u.end]), Endings()
        dense = [np.zeros(u.big ** 2, np.int64) for _ in (_START, _BIG)]
        line, rare, places, length = [start], [], [], 1

        def flushed():
            joined, at = np.concatenate(line), np.concatenate(places)
            names = np.zeros(len(joined), np.int64)
            joined[at] = [groups[w[-2:]] + u.core for w in rare]
            names[at] = hashes(rare)
            yield from counted(joined, names, dense)

        for (texts,) in slices(batches):
            for text in texts:
                words = text.lower().split()
                numbers = np.fromiter(map(find, words, repeat(-1)), np.int64, len(words))
                at = np.flatnonzero(numbers < 0).tolist()
                places.append(np.array(at, np.int64) + length)
                rare += [words[i] for i in at]
                line += [numbers, start]
                length += len(words) + 1
                if length > PAIR_TOKENS:
                    yield from flushed()
                    line, rare, places, length = [start], [], [], 1
        if length > 1:
            yield from flushed()
        for kind, sums in zip((_START, _BIG), dense, strict=True):
            at = np.flatnonzero(sums)
            yield from dealt(kind, [at], sums[at])

    def merge(batches):
        last, held, kept = None, 0, []

        def whole():
            columns = [np.concatenate(c) for c in zip(*[c for c, _ in kept], strict=True)]
            return _merged(columns, np.concatenate([n for _, n in kept]))

        for batch in batches:
            for row in batch.to_pylist():
                if last not in (None, (row["kind"], row["part"])):
                    yield _rows(last[0], [last[1]], [whole()])
                    held, kept = 0, []
                last = row["kind"], row["part"]
                kept.append(_unpacked(row))
                held += len(kept[-1][1])
                if held > MERGE_ENTRIES:
                    kept = [whole()]
                    held = len(kept[0][1]) // 2
        if kept:
            yield _rows(last[0], [last[1]], [whole()])

    raw = bounded(_texts(docs, text_col, learns)).mapInArrow(run, _PACKED)
    return (raw.repartition(-(-parts // PARTS), "kind", "part").sortWithinPartitions("kind", "part")
            .mapInArrow(merge, _PACKED))


def _summed(rows: DataFrame, size: int, tasks: int) -> np.ndarray:
    """The sum of the arrays in the one binary column of ``rows``, at most ``tasks`` of them, in levels
    of 32 to 1."""
    def add(batches):
        import pyarrow as pa

        total = None
        for batch in batches:
            for value in batch.column(0):
                one = np.frombuffer(value.as_py(), np.int64)
                total = one.copy() if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    while tasks > 32:
        tasks = -(-tasks // 32)
        rows = rows.repartition(tasks).mapInArrow(add, "sums binary")
    found = [np.frombuffer(bytes(r.sums), np.int64) for r in rows.collect()]
    return np.sum(found, 0) if found else np.zeros(size, np.int64)


def _sides(row: dict, units: Units):
    """Of an _OWN row: owner, other unit, whether it comes before, times."""
    (code,), n = _unpacked(row)
    owner, other = np.divmod(code, 2 * units.count)
    back = other >= units.count
    return owner, np.where(back, other - units.count, other), back, n


def count_grid(own: DataFrame, units: Units, of: np.ndarray, k: int,
               parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The grid of all pairs with a known word that is no big unit, the same without groups of rare
    words, and the classes that such words give each big unit as neighbours."""
    shared = own.sparkSession.sparkContext.broadcast((units, of))
    cells = k * k

    def run(batches):
        import pyarrow as pa

        u, of = shared.value
        total = np.zeros(2 * cells + u.big * 2 * k, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                owner, other, back, n = _sides(row, u)
                mine, theirs = of[owner], of[other]
                # Two words with lists of their own stand in both; the first one's counts.
                once = ~back | (other < u.big)
                cell = np.where(back, theirs * k + mine, mine * k + theirs) + cells * u.rare(other)
                total[:2 * cells] += np.bincount(cell[once], n[once], 2 * cells).astype(np.int64)
                big = other < u.big
                at = other[big] * (2 * k) + np.where(back[big], 0, k) + mine[big]
                total[2 * cells:] += np.bincount(at, n[big], u.big * 2 * k).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    sums = _summed(own.mapInArrow(run, "sums binary"), 2 * cells + units.big * 2 * k, parts).astype(float)
    known = sums[:cells].reshape(k, k)
    return (known + sums[cells:2 * cells].reshape(k, k), known,
            sums[2 * cells:].reshape(units.big, 2 * k))


def move_known(own: DataFrame, units: Units, of: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """The classes after every known word with a list of its own has moved; tasks move theirs one
    block after the other, each against a grid of its own."""
    k = len(grid)
    shared = own.sparkSession.sparkContext.broadcast((units, of, grid))

    def run(batches):
        import pyarrow as pa

        u, of, grid = shared.value
        grid = grid.copy()
        for batch in batches:
            for row in batch.to_pylist():
                owner, other, back, n = _sides(row, u)
                words, place = np.unique(owner, return_inverse=True)
                near = np.bincount(place * (2 * k) + np.where(back, k, 0) + of[other], n,
                                   len(words) * 2 * k).reshape(-1, 2 * k)
                self_ = (owner == other) & ~back
                repeats = np.bincount(place[self_], n[self_], len(words))
                mine = of[words]
                move_words(grid, near, mine, repeats)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words.astype(np.int32).tobytes()], pa.binary()),
                     pa.array([mine.astype(np.int32).tobytes()], pa.binary())], names=["unit", "cls"])

    out = of.copy()
    for r in own.mapInArrow(run, "unit binary, cls binary").collect():
        out[np.frombuffer(bytes(r.unit), np.int32)] = np.frombuffer(bytes(r.cls), np.int32)
    return out


@dataclass
class Grids:
    """The classes of all units, the grid they give, and that of the pairs of known words only."""

    of: np.ndarray
    whole: np.ndarray
    known: np.ndarray


def exchange_known(own: DataFrame, pairs: np.ndarray, units: Units, of: np.ndarray, k: int,
                   parts: int, least_share: float = LEAST_SHARE) -> tuple[Grids, list[float]]:
    """Rounds over all units until one adds less than ``least_share`` of the gain so far; the classes
    and the likelihood before each round. A round that loses is not kept."""
    reached: list[float] = []
    kept = None
    live = np.flatnonzero(~units.rare(np.arange(units.big)))
    while True:
        grid, known, outer = count_grid(own, units, of, k, parts)
        grid += _grid_of(pairs, of, k)
        known += _grid_of(pairs[np.ix_(live, live)], of[live], k)
        reached.append(likelihood(grid))
        if kept is not None:
            gain = reached[-1] - reached[-2]
            if gain <= 0:
                return kept, reached
            if gain < least_share * (reached[-1] - reached[0]):
                return Grids(of, grid, known), reached
        kept, of = Grids(of, grid.copy(), known), of.copy()
        member = np.zeros((units.big, k))
        member[np.arange(units.big), of[:units.big]] = 1
        mine = of[:units.big].copy()
        _move_until_none(pairs, pairs @ member + outer[:, :k], pairs.T @ member + outer[:, k:], mine,
                         grid)
        of[:units.big] = mine
        of = move_known(own, units, of, grid)
        if (of == kept.of).all():
            return kept, reached


def move_rare(rare: DataFrame, units: Units, of: np.ndarray, grid: np.ndarray) -> DataFrame:
    """(unit, cls, sums): every rare word leaves the group of its ending for its best class. One row
    per word; ``sums``, in one row of a task, is the grid of its pairs with known words."""
    k = len(grid)
    shared = rare.sparkSession.sparkContext.broadcast((units, of, grid))

    def run(batches):
        import pyarrow as pa

        u, of, grid = shared.value
        grid, found = grid.copy(), np.zeros(k * k, np.int64)
        groups = of[u.core:u.end]

        def rows(words, classes, sums=None):
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.int64()), pa.array(classes, pa.int32()),
                 pa.array([sums] * len(words), pa.binary())], names=["unit", "cls", "sums"])

        for batch in batches:
            for row in batch.to_pylist():
                (name, beside, after), n = _unpacked(row)
                before, group = np.divmod(beside, ENDINGS)
                ends = np.flatnonzero(np.r_[name[1:] != name[:-1], True]) + 1
                # Whole words, RARE_WORDS at a time.
                for lo in range(0, len(ends), RARE_WORDS):
                    part = slice(ends[lo - 1] if lo else 0, ends[min(lo + RARE_WORDS, len(ends)) - 1])
                    words, first, place = np.unique(name[part], return_index=True, return_inverse=True)
                    ca, cb, m = of[after[part]], of[before[part]], n[part]
                    near = (np.bincount(place * (2 * k) + ca, m, len(words) * 2 * k)
                            + np.bincount(place * (2 * k) + k + cb, m, len(words) * 2 * k)
                            ).reshape(-1, 2 * k)
                    mine = groups[group[part][first]]
                    move_words(grid, near, mine, np.zeros(len(words)), RARE_BLOCK)
                    own = mine[place]
                    for other, cell, ok in ((ca, own * k + ca, ~u.rare(after[part])),
                                            (cb, cb * k + own, ~u.rare(before[part]))):
                        found += np.bincount(cell[ok], m[ok], k * k).astype(np.int64)
                    yield rows(words, mine)
        yield rows([None], [None], found.tobytes())

    return rare.mapInArrow(run, "unit bigint, cls int, sums binary")


def learn(docs: DataFrame, text_col: str = "text", learns: Column | None = None,
          core_words: int = CORE_WORDS, classes: int = CLASSES, smoothing: float = SMOOTHING,
          known_words: int = FREQUENT_WORDS, least_share: float = LEAST_SHARE,
          parts: int | None = None) -> ClassModel:
    """Fit on the documents for which ``learns`` holds (all without it).

    ``parts``: the pieces that the pairs are dealt to, by default ``PARTS`` for each task of a shuffle.
    """
    spark = docs.sparkSession
    parts = parts or PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = written(count_words(docs, text_col, learns), "words")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    end = counts.where("word is null").first()
    top = _most_frequent(counts, known_words)
    known = top["word"].to_pylist()
    n_known = top["n"].to_numpy()
    units = Units(known, core_words)
    path = scratch_dir(spark, "lm-links")
    with shuffles_dropped(spark):
        count_links(docs, text_col, learns, units, parts).write.partitionBy("kind").parquet(path)
        links = spark.read.schema(_PACKED.replace("kind int, ", "") + ", kind int").parquet(path)
        own, rare = (links.where(F.col("kind") == kind) for kind in (_OWN, _RARE))
        of = exchange(_matrix(links, _START, units.big), classes)
        k = int(of.max()) + 1
        pairs = _matrix(links, _BIG, units.big)
        grids, _ = exchange_known(own, pairs, units, of[units.start], k, parts, least_share)
        of = grids.of
        moved = written(move_rare(rare, units, of, grids.whole), "lm-rare")
        # The grid of the model: known words, then rare words with known ones, then with rare ones.
        grid = grids.known + _summed(moved.where("sums is not null").select("sums"), k * k,
                        parts).reshape(k, k)
        classes_of = moved.where("unit is not null").select("unit", "cls")
        for r in _rare_pairs(links, classes_of).collect():
            grid[r.a, r.b] += r.n
    steps = np.log10((grid + smoothing) / (grid.sum(1, keepdims=True) + smoothing * k))
    others = written(_numbered(counts.where(~_is_known(top)).where("word is not null"))
                     .join(classes_of, "unit").select("word", "n", "cls"), "rare-words")
    removed(spark, path)
    forgotten(moved)
    of_known = of[units.known]
    class_tokens = np.bincount(of_known, n_known, k)
    class_words = np.bincount(of_known, minlength=k).astype(float)
    if end:
        class_tokens[of[units.end]] += end.n
        class_words[of[units.end]] += 1
    for row in (others.groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words"))
                .collect()):
        class_tokens[row.cls] += row.n
        class_words[row.cls] += row.words
    return ClassModel(others, int(tokens), int(distinct), known, n_known, int(end.n) if end else 0,
                      of_known, int(of[units.end]), of[units.core:units.end], steps, class_tokens,
                      class_words, smoothing)


def _most_frequent(counts: DataFrame, most: int):
    """The ``most`` most frequent words of at most KNOWN_BYTES, of equal ones the smaller bytes first."""
    short = counts.where((F.length("word") <= KNOWN_BYTES) & F.col("word").isNotNull())
    # A first look finds a count that at least so many words reach, so that tasks need not each
    # send that many.
    row = short.agg(*[F.count_if(F.col("n") >= (1 << i)).alias(f"c{i}") for i in range(1, 50)]).first()
    least = max([0] + [i for i in range(1, 50) if row[f"c{i}"] >= most])
    return short.where(F.col("n") >= (1 << least)).orderBy(F.desc("n"), "word").limit(most).toArrow()


def _is_known(top) -> Column:
    """Whether a row of the counts is one of ``top``."""
    if not len(top):
        return F.lit(False)
    n, word = F.lit(top["n"][-1].as_py()), F.lit(bytearray(top["word"][-1].as_py()))
    return (F.length("word") <= KNOWN_BYTES) & (
        (F.col("n") > n) | ((F.col("n") == n) & (F.col("word") <= word)))


def _matrix(links: DataFrame, kind: int, size: int) -> np.ndarray:
    """The counted pairs of big units: one row of packed cells per part."""
    out = np.zeros(size * size)
    for row in links.where(F.col("kind") == kind).collect():
        (code,), n = _unpacked({c: v if isinstance(v, int) or v is None else bytes(v)
                                for c, v in row.asDict().items()})
        out[code] += n
    return out.reshape(size, size)


def _grid_of(pairs: np.ndarray, of: np.ndarray, k: int) -> np.ndarray:
    member = np.zeros((len(pairs), k))
    member[np.arange(len(pairs)), of[:len(pairs)]] = 1
    return member.T @ pairs @ member


def _rare_pairs(links: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b, n): how often a rare word of class b follows one of class a."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                (a, b), n = _unpacked(row)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)],
                                                 names=["first", "second", "n"])

    rows = links.where(F.col("kind") == _BOTH).mapInArrow(run, "first bigint, second bigint, n bigint")
    return (rows.join(classes.select(F.col("unit").alias("first"), F.col("cls").alias("a")), "first")
            .join(classes.select(F.col("unit").alias("second"), F.col("cls").alias("b")), "second")
            .groupBy("a", "b").agg(F.sum("n").alias("n")))


def _numbered(counts: DataFrame) -> DataFrame:
    """The counted words with their hashes."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            units = hashes(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(units, pa.int64())],
                                             names=["word", "n", "unit"])

    return counts.mapInArrow(run, "word binary, n bigint, unit bigint")


def _base(count, model: ClassModel):
    return np.log10((count + 0.1) / (model.tokens + 0.1 * (model.distinct + 1)))


def _emission(count, of, model: ClassModel):
    return np.log10((count + model.smoothing)
                    / (model.class_tokens[of] + model.smoothing * (model.class_words[of] + 1)))


def score_texts(docs: DataFrame, model: ClassModel, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per document: id, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    spark = docs.sparkSession
    n_frequent = len(model.frequent)
    # The end is looked up like a frequent word, behind them.
    counts = np.append(model.frequent_counts, model.end_count)
    of = np.append(model.frequent_classes, model.end_class).astype(np.int64)
    shared = spark.sparkContext.broadcast({
        "words": {w: i for i, w in enumerate(model.frequent)}, "of": of,
        "base": _base(counts, model), "emission": _emission(counts, of, model),
        "known": counts > 0, "steps": model.steps})

    def run(batches):
        import pyarrow as pa

        m = shared.value
        find, known, steps = m["words"].get, m["known"], m["steps"]
        for keys, texts in slices(batches):
            rows = []
            for text in texts:
                words = text.lower().split()
                words.append(b"")
                at = np.fromiter(map(find, words, repeat(-1)), np.int64, len(words))
                at[-1] = n_frequent
                others = np.flatnonzero(at < 0)
                labels = np.where(at < 0, -1, m["of"][at])
                before = np.concatenate([labels[-1:], labels[:-1]])
                after = np.concatenate([labels[1:], labels[:1]])
                # Rare words with the classes beside them (-1: a rare word too), and
                # pairs of rare words.
                rare = [words[i] for i in others.tolist()]
                two = others[after[others] < 0].tolist()
                seen = at[at >= 0]
                both = (labels >= 0) & (before >= 0)
                rows.append((len(words), int(known[seen].sum()), float(m["base"][seen].sum()),
                             float(m["emission"][seen].sum()
                                   + steps[before[both], labels[both]].sum()),
                             rare, before[others].astype(np.int32), after[others].astype(np.int32),
                             [words[i] for i in two], [words[i + 1] for i in two]))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()),
                     *[pa.list_(pa.int32())] * 2, *[pa.list_(pa.binary())] * 2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64())]
                + [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                names=["id", "n_tokens", "n_known", "base", "score", "rare", "before", "after",
                       "left", "right"])

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                       utf8(text_col).alias("text"))
    parts = written(bounded(rows).mapInArrow(
        run, "id bigint, n_tokens bigint, n_known bigint, base double, score double, "
             "rare array<binary>, before array<int>, after array<int>, "
             "left array<binary>, right array<binary>")
        .withColumn("row", F.monotonically_increasing_id()), "lm-parts")
    # Arrays of fixed size: the steps, the denominators' log10 by class, unseen words' classes.
    k = len(model.steps)
    table = F.lit(model.steps.ravel())
    scale = F.lit(np.log10(model.class_tokens + model.smoothing * (model.class_words + 1)))
    unseen = F.lit(model.endings.astype(np.int32))
    words = model.rare

    def step(a: Column, b: Column) -> Column:
        return F.when((a >= 0) & (b >= 0), F.element_at(table, a * k + b + 1)).otherwise(0.0)

    def class_of(word: str, cls: str) -> Column:
        return F.coalesce(F.col(cls), F.element_at(unseen, ending_column(word) + 1))

    rest = (parts.select("row", F.explode(F.arrays_zip("rare", "before", "after")).alias("x"))
            .select("row", F.col("x.rare").alias("word"), "x.before", "x.after")
            .join(words, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
            .withColumn("cls", class_of("word", "cls")))
    base = F.log10((F.col("n") + 0.1) / F.lit(model.tokens + 0.1 * (model.distinct + 1)))
    score = (F.log10(F.col("n") + model.smoothing) - F.element_at(scale, F.col("cls") + 1)
             + step(F.col("before"), F.col("cls")) + step(F.col("cls"), F.col("after")))
    links = (parts.select("row", F.explode(F.arrays_zip("left", "right")).alias("x"))
             .select("row", F.col("x.left").alias("left"), F.col("x.right").alias("right"))
             .join(words.select(F.col("word").alias("left"), F.col("cls").alias("a")), "left", "left")
             .join(words.select(F.col("word").alias("right"), F.col("cls").alias("b")), "right",
                   "left"))
    sums = (rest.select("row", (F.col("n") > 0).cast("bigint").alias("known"),
                        base.alias("base"), score.alias("score"))
            .unionByName(links.select("row", F.lit(0).cast("bigint").alias("known"),
                                      F.lit(0.0).alias("base"),
                                      step(class_of("left", "a"), class_of("right", "b"))
                                      .alias("score")))
            .groupBy("row").agg(F.sum("known").alias("more_known"),
                                F.sum("base").alias("more_base"),
                                F.sum("score").alias("more_score")))
    zero = F.lit(0.0)
    return (parts.select("row", "id", "n_tokens", "n_known", "base", "score")
            .join(sums, "row", "left")
            .select("id", "n_tokens",
                    (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                    F.lit(model.tokens).cast("bigint").alias("train_tokens"),
                    (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
                    (F.col("score") + F.coalesce("more_score", zero)).alias("score"))
            .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))))
