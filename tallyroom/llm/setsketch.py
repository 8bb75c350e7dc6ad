"""Near-duplicate documents by SetSketch registers, bands, a likelihood filter and full sets.

A document is the set of its word shingles. Its sketch has ``REGISTERS`` registers; register i
holds floor(1 - log_b x), clipped to 16 bits, where x is the least of independent
exponential values, one per shingle and register. Sketches of parts merge by the register-wise
maximum, and two registers agree with a probability close to the Jaccard similarity.

1. ``sketch_documents``: one pass over the texts gives set size, set digest and registers.
   Documents of one set become one node (the least id), so copies cost one row.
2. Groups of ``BAND`` registers are bucketed. Each node is offered the bucket leader that
   agrees with it most, and the pair is verified on the full shingle sets.
3. Verified links are joined to components. Buckets that still hold several components
   are searched inside tasks, in blocks: of all pairs of nodes of different components, those
   whose likelihood estimate reaches the threshold less a margin are compared on their
   full sets; first only the most similar ones of each node, which joins most components,
   then all that are left.

So no pair inside a component is ever formed, and no pair that could be a link
is left out: the estimate only drops pairs more than ``MARGIN`` below the threshold,
over four standard errors of the sketch. A pair at the threshold shares no bucket with a
probability of about 1e-7 (``(1 - 0.8^BAND)^BANDS``); links are kept only after full
sets agreed.

Defined results: a null or empty text has the empty set and is linked with nothing; a text with fewer
words than a shingle is one shingle; rows that share an id are one node; a row without id is
linked with nothing, has no component and is kept; the component is the least id; an empty
table gives no rows. Columns of other names are never read, so clashing names cannot matter.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, perhaps_named, slices, unused, utf8, written
from .links import components, merge

REGISTERS = 200
BAND = 5
BANDS = REGISTERS // BAND
BASE = 1.001
LARGEST = (1 << 16) - 1
SHINGLE = 5
#: Least similarity of a link, in percent.
PERCENT = 80
MARGIN = 0.12
#: Members of a bucket that one task compares with as many others.
BLOCK = 2048
#: Bytes of full sets (8 a shingle) from which on one side of a meeting is cut in pieces. A task holds two
#: pieces at a time, each with at most one set more than this.
SET_BYTES = 64 << 20
#: Bits of a piece's number below that of its block.
PIECE_BITS = 16
#: Most similar nodes of other components that each node is verified with before all others.
FIRST_PAIRS = 4

_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit number for each 64-bit number."""
    x = x + np.uint64(_MIX[2])
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


class WordNumbers(dict):
    """64-bit numbers of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        number = xxhash.xxh3_64_intdigest(word)
        if len(self) < 1 << 17:
            self[word] = number
        return number


def shingles(text: bytes, width: int, numbers: WordNumbers) -> np.ndarray:
    """The distinct shingles of a text, as sorted 64-bit numbers."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.array(list(map(numbers.__getitem__, words)), np.uint64)
    width = min(width, len(words))
    n = len(words) - width + 1
    # A sequence of another length starts from another number.
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = _mix(out ^ codes[k:k + n])
    return np.unique(out)


def sketch(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """Registers of every set, as rows.

    Each shingle is a Poisson process: its points come in rising order, each on a register
    of its own choice, so the first point on a register is exponential and the
    registers are independent. A point above the largest minimum of its set can change
    nothing, so most shingles stop at their first point.
    """
    n = len(sets)
    least = np.full(n * registers, np.inf)
    sizes = np.array([len(s) for s in sets], np.int64)
    element = np.concatenate(sets) if n else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    at = np.zeros(len(element))
    limit = np.full(n, np.inf)
    point = 0
    while len(element):
        point += 1
        # One number for the time to the next point, one for its register.
        u = _mix(element + np.uint64((2 * point * _MIX[2]) & 0xFFFFFFFFFFFFFFFF))
        at = at - np.log1p(-((u >> np.uint64(11)).astype(np.float64) * 2.0**-53)) / registers
        stays = at < limit[owner]
        element, owner, at, u = element[stays], owner[stays], at[stays], u[stays]
        register = (_mix(u) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(least, owner * registers + register, at)
        if point & (point - 1) == 0 or point % 16 == 0:
            limit = least.reshape(n, registers).max(1)
    with np.errstate(divide="ignore"):
        level = np.floor(1 - np.log(least.reshape(n, registers)) / math.log(BASE))
    # The middle of the 16 bits stands for a minimum of 1; sets from one shingle to 10^13 fit.
    return np.clip(level + 30000, 0, LARGEST).astype(np.uint16)


def sketch_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     width: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, digest, registers) of every row; no digest for the empty set."""
    def run(batches):
        import pyarrow as pa

        numbers = WordNumbers()
        for keys, texts in slices(batches):
            sets = [shingles(t, width, numbers) for t in texts]
            rows = sketch(sets)
            filled = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if f else None
                           for s, f in zip(sets, filled, strict=True)], pa.binary()),
                 pa.array([r.tobytes() if f else None
                           for r, f in zip(rows, filled, strict=True)], pa.binary())],
                names=["id", "n_shingles", "digest", "registers"])

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                       utf8(text_col).alias("text"))
    return bounded(rows).mapInArrow(run, "id bigint, n_shingles bigint, digest binary, registers binary")


def _count(marks: np.ndarray) -> np.ndarray:
    """Marks of each row."""
    return np.bitwise_count(np.packbits(marks, axis=-1)).sum(-1, dtype=np.int64)


def likely(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray,
           similarity: float) -> np.ndarray:
    """Slope of the joint log-likelihood of two sketches at this Jaccard similarity.

    The counts of registers that are larger, smaller and equal are multinomial, with
    probabilities that follow from the similarity and the set sizes, which are known
    exactly. The likelihood is concave, so the estimate is at least ``similarity`` exactly
    where the slope there is not negative.
    """
    more, equal = _count(a > b), _count(a == b)
    less = a.shape[-1] - more - equal
    u = size_a / (size_a + size_b)
    v = 1 - u
    j = np.minimum(similarity, np.minimum(u / v, v / u) * (1 - 1e-9))
    scale = (BASE - 1) / BASE
    log_b = math.log(BASE)

    def p(x):
        return -np.log1p(-x * scale) / log_b

    def slope(x):
        return scale / (1 - x * scale) / log_b

    x, y = u - v * j, v - u * j
    p_more, p_less = np.maximum(p(x), 1e-300), np.maximum(p(y), 1e-300)
    p_equal = np.maximum(1 - p_more - p_less, 1e-300)
    dx, dy = -v * slope(x), -u * slope(y)
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        return (np.where(more > 0, more * dx / p_more, 0) + np.where(less > 0, less * dy / p_less, 0)
                - np.where(equal > 0, equal * (dx + dy) / p_equal, 0))


def _similar(a, b, size_a, size_b, percent: int) -> np.ndarray:
    """Pairs that may be links: sizes allow it, and the estimate is not below the margin."""
    small, large = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    fits = 100 * small >= percent * large
    return fits & (likely(a, b, size_a, size_b, percent / 100 - MARGIN) >= 0)


def _buckets(nodes: DataFrame) -> DataFrame:
    """(band, bucket, node, leader): all buckets with two nodes or more."""
    bands = F.array(*[F.xxhash64(F.lit(i), F.substring("registers", 2 * BAND * i + 1, 2 * BAND))
                      for i in range(BANDS)])
    rows = nodes.select("node", F.posexplode(bands).alias("band", "bucket"))
    shared = (rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"),
        # A leader of its own in every bucket, not the same node in all.
        F.min(F.struct(F.xxhash64("bucket", "node"), "node"))["node"].alias("leader"))
        .where("members > 1"))
    return rows.join(shared.select("bucket", "leader"), "bucket")


def _best_leaders(buckets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: every node with the leader that it shares most buckets with, if similar."""
    offers = (buckets.where("node != leader").groupBy("node", "leader")
              .agg(F.count(F.lit(1)).alias("n")))
    best = offers.groupBy("node").agg(
        F.max(F.struct("n", (-F.col("leader")).alias("last"), "leader"))["leader"].alias("leader"))
    own = nodes.select("node", F.col("size").alias("size_a"), F.col("registers").alias("ra"))
    other = nodes.select(F.col("node").alias("leader"), F.col("size").alias("size_b"),
                         F.col("registers").alias("rb"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = (_registers(batch.column(k)) for k in ("ra", "rb"))
            size = [batch.column(k).to_numpy() for k in ("size_a", "size_b")]
            keep = _similar(a, b, *size, percent)
            yield batch.select(["node", "leader"]).filter(pa.array(keep))

    return (best.join(own, "node").join(other, "leader")
            .select("node", "leader", "size_a", "size_b", "ra", "rb")
            .mapInArrow(run, "node bigint, leader bigint")
            .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
            .distinct())


def _registers(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint16).reshape(len(rows), REGISTERS)


def _named_texts(docs: DataFrame, id_col: str, text_col: str, named: DataFrame) -> DataFrame:
    """(node, text) of the named documents; few others reach the shuffle."""
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("node"),
                        utf8(text_col).alias("text"))
    return (perhaps_named(texts, "node", named, "__perhaps").where("__perhaps").drop("__perhaps")
            .join(named, "node"))


def verify(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int,
           percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have the similarity.

    Texts of the documents named in pairs travel to their pairs, compressed as they are. The
    many pairs of one hot document may be split over tasks by the planner.
    """
    named = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = written(_named_texts(docs, id_col, text_col, named), "pair-texts")

    def run(batches):
        import pyarrow as pa

        numbers = WordNumbers()
        for a, b, left, right in slices(batches):
            links = []
            for x, y in zip(left, right, strict=True):
                s, t = shingles(x, width, numbers), shingles(y, width, numbers)
                common = len(np.intersect1d(s, t, assume_unique=True))
                links.append(len(s) > 0 and 100 * common >= percent * (len(s) + len(t) - common))
            out = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             names=["a", "b"])
            yield out.filter(pa.array(links, pa.bool_()))

    joined = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
              .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b"))
    return joined.select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint").distinct()


_MEMBER = ("band int, bucket bigint, p int, q int, part int, node bigint, component bigint, "
           "size bigint, registers binary")
#: The same after blocks were cut in pieces: both numbers are in one.
_CUT = _MEMBER.replace("p int, q int, part int", "p bigint, q bigint, part bigint")


def _meetings(buckets: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``_MEMBER``: the nodes of every bucket that holds several components. A
    bucket of more than ``BLOCK`` nodes is cut in blocks, and each two blocks meet (p, q)."""
    member = (buckets.join(labels, "node", "left")
              .select("band", "bucket", "node", F.coalesce("component", "node").alias("component")))
    mixed = member.groupBy("bucket").agg(
        F.min("component").alias("x"), F.max("component").alias("y"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts")).where("x != y")
    member = (member.join(mixed.select("bucket", "parts"), "bucket")
              .join(nodes.select("node", "size", "registers"), "node")
              .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")))
    # Of a large bucket every block meets every other: a row goes once to each meeting.
    return (member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("band", "bucket", F.least("part", "other").alias("p"),
                    F.greatest("part", "other").alias("q"), "part", "node", "component",
                    "size", "registers"))


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q")


def _best_across(rows: DataFrame, percent: int, most: int) -> DataFrame:
    """Likely pairs (a, b), a < b, of different components: about the most similar of each node."""
    def run(batches):
        yield from _best_pairs(batches, percent, most)

    pairs = _dealt(rows).mapInArrow(run, "node bigint, other bigint, equal int").distinct()
    best = Window.partitionBy("node").orderBy(F.desc("equal"), "other")
    return (pairs.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most)
            .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
            .distinct())


def _links_across(rows: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int,
                  percent: int) -> DataFrame:
    """All links (a, b) between different components. No pair leaves a task unless it is one:
    the first pass keeps the nodes that stand in a likely pair and cuts meetings by the bytes of
    their full sets, the second, which has these, compares the likely pairs again."""
    most_bytes = SET_BYTES

    def involved(batches):
        yield from _likely_members(batches, percent, most_bytes)

    def run(batches):
        yield from _true_links(batches, percent)

    likely = written(_dealt(rows).mapInArrow(involved, _CUT), "likely")
    sets = written(_sets(likely.select("node").distinct(), docs, id_col, text_col, width), "sets")
    return _dealt(likely.join(sets, "node").select(*likely.columns, "shingles")).mapInArrow(
        run, "a bigint, b bigint").distinct()


def _sets(named: DataFrame, docs: DataFrame, id_col: str, text_col: str,
          width: int) -> DataFrame:
    """(node, shingles): the full sets of the named documents."""
    def run(batches):
        import pyarrow as pa

        numbers = WordNumbers()
        for keys, texts in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()),
                 pa.array([shingles(t, width, numbers).tobytes() for t in texts], pa.binary())],
                names=["node", "shingles"])

    texts = _named_texts(docs, id_col, text_col, named)
    return texts.select("node", "text").mapInArrow(run, "node bigint, shingles binary")


#: Pairs that a task compares at a time.
PAIRS = 1 << 14


class _Meeting:
    """Rows of some whole meetings, as arrays."""

    def __init__(self, batch):
        take = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
        self.rows = batch
        self.band, self.bucket, self.p, self.q = map(take, ("band", "bucket", "p", "q"))
        self.part, self.node, self.component = map(take, ("part", "node", "component"))
        self.size = take("size").astype(np.float64)
        self.registers = _registers(batch.column("registers"))

    def groups(self):
        """Ranges of rows that meet."""
        change = ((self.bucket[1:] != self.bucket[:-1]) | (self.p[1:] != self.p[:-1])
                  | (self.q[1:] != self.q[:-1]))
        edges = np.concatenate([[0], np.flatnonzero(change) + 1, [len(self.bucket)]])
        return zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)

    def partners(self, lo: int, hi: int, percent: int, once: bool):
        """For each row of a meeting the rows of other components that its size admits;
        ``once``: each two rows once."""
        part, node = self.part[lo:hi], self.node[lo:hi]
        component, size = self.component[lo:hi], self.size[lo:hi]
        inside = self.p[lo] == self.q[lo]
        for i in np.flatnonzero(part == self.p[lo]).tolist():
            partner = (part == self.q[lo]) & (component != component[i])
            partner &= 100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])
            if inside and once:
                partner &= node > node[i]
            others = np.flatnonzero(partner)
            if len(others):
                yield np.full(len(others), lo + i), lo + others

    def cut(self, rows: np.ndarray, most_bytes: int):
        """(rows, p, q, part) of smaller meetings in which each two of the chosen rows that met here
        meet once more: each block is cut in pieces by the bytes of its full sets, and each two
        pieces that have to be compared meet. Mostly there is one piece."""
        for lo, hi in self.groups():
            own = lo + np.flatnonzero(rows[lo:hi])
            if not len(own):
                continue
            ends, piece = (int(self.p[lo]), int(self.q[lo])), np.zeros(len(own), np.int64)
            pieces = []
            for end in ends:
                at = np.flatnonzero(self.part[own] == end)
                own_bytes = 8 * self.size[own[at]]
                piece[at] = (np.cumsum(own_bytes) - own_bytes) // most_bytes
                pieces.append(np.unique(piece[at]).tolist())
            part = (self.part[own].astype(np.int64) << PIECE_BITS) | piece
            for u in pieces[0]:
                for v in pieces[1]:
                    if ends[0] == ends[1] and v < u:
                        continue
                    p, q = (ends[0] << PIECE_BITS) | u, (ends[1] << PIECE_BITS) | v
                    here = (part == p) | (part == q)
                    yield own[here], p, q, part[here]

    def likely(self, percent: int, once: bool):
        """(first, second, equal registers, whether this is their first common band) of the
        likely pairs, some at a time."""
        first, second, held = [], [], 0
        for lo, hi in self.groups():
            for x, y in self.partners(lo, hi, percent, once):
                first.append(x)
                second.append(y)
                held += len(x)
                if held >= PAIRS:
                    yield self._keep(np.concatenate(first), np.concatenate(second), percent)
                    first, second, held = [], [], 0
        if held:
            yield self._keep(np.concatenate(first), np.concatenate(second), percent)

    def _keep(self, first: np.ndarray, second: np.ndarray, percent: int):
        a, b = self.registers[first], self.registers[second]
        keep = _similar(a, b, self.size[first], self.size[second], percent)
        first, second, agree = first[keep], second[keep], (a == b)[keep]
        bands = agree.reshape(-1, BANDS, BAND).all(2)
        here = np.argmax(bands, 1) == self.band[first]
        return first, second, agree.sum(1).astype(np.int32), here


def _whole_meetings(batches):
    """Sorted rows as meetings; the last one of a batch may go on in the next."""
    import pyarrow as pa

    rest = None
    for batch in batches:
        rows = batch if rest is None else pa.concat_batches([rest, batch])
        if not rows.num_rows:
            continue
        key = [rows.column(k) for k in ("bucket", "p", "q")]
        last = [k[-1].as_py() for k in key]
        cut = rows.num_rows - 1
        while cut and [k[cut - 1].as_py() for k in key] == last:
            cut -= 1
        rest = rows.slice(cut)
        if cut:
            yield _Meeting(rows.slice(0, cut))
    if rest is not None:
        yield _Meeting(rest)


def _best_pairs(batches, percent: int, most: int):
    import pyarrow as pa

    for meeting in _whole_meetings(batches):
        for first, second, equal, _ in meeting.likely(percent, once=False):
            order = np.lexsort((-equal, first))
            place = np.arange(len(order)) - np.searchsorted(first[order], first[order])
            pick = order[place < most]
            yield pa.RecordBatch.from_arrays(
                [pa.array(meeting.node[first[pick]]), pa.array(meeting.node[second[pick]]),
                 pa.array(equal[pick])], names=["node", "other", "equal"])


def _likely_members(batches, percent: int, most_bytes: int):
    import pyarrow as pa

    for meeting in _whole_meetings(batches):
        rows = np.zeros(len(meeting.node), bool)
        for first, second, _, here in meeting.likely(percent, once=True):
            rows[first[here]] = rows[second[here]] = True
        for take, p, q, part in meeting.cut(rows, most_bytes):
            kept = meeting.rows.take(pa.array(take))
            cut = {"p": np.full(len(take), p), "q": np.full(len(take), q), "part": part}
            yield pa.RecordBatch.from_arrays(
                [pa.array(cut[name], pa.int64()) if name in cut else kept.column(name)
                 for name in kept.schema.names], names=kept.schema.names)


def _true_links(batches, percent: int):
    import pyarrow as pa

    for meeting in _whole_meetings(batches):
        sets = [np.frombuffer(x, np.uint64) for x in meeting.rows.column("shingles").to_pylist()]
        links = []
        for first, second, _, here in meeting.likely(percent, once=True):
            for i, j in zip(first[here].tolist(), second[here].tolist(), strict=True):
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    links.append((i, j))
        ends = np.array(links, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(meeting.node[ends[:, 0]]), pa.array(meeting.node[ends[:, 1]])],
            names=["a", "b"])


def _same_id(rows: DataFrame, own: DataFrame) -> DataFrame:
    """Links (a, b) between the nodes of one id that stands on rows with different sets."""
    several = (rows.where("id is not null and digest is not null").groupBy("id")
               .agg(F.min("digest").alias("x"), F.max("digest").alias("y"))
               .where("x != y").select("id"))
    of = rows.select("id", "digest").join(several, "id").join(own, "digest").select("id", "node")
    least = of.groupBy("id").agg(F.min("node").alias("a"))
    return of.join(least, "id").select("a", F.col("node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: id, n_shingles, component_id, kept."""
    rows = written(sketch_documents(docs, id_col, text_col, width), "sketches")
    sets = rows.where("id is not null and digest is not null").groupBy("digest").agg(
        F.min("id").alias("node"), F.first("n_shingles").alias("size"),
        F.first("registers").alias("registers"))
    nodes = written(sets, "nodes")
    buckets = written(_buckets(nodes), "buckets")
    pairs = written(_best_leaders(buckets, nodes, percent), "pairs", compact=True)
    own = nodes.select("digest", "node")
    links = verify(pairs, docs, id_col, text_col, width, percent).unionByName(
        _same_id(rows, own))
    labels = components(written(links, "links", compact=True))
    fresh = written(_best_across(_meetings(buckets, nodes, labels), percent, FIRST_PAIRS)
                    .join(pairs, ["a", "b"], "left_anti"), "pairs", compact=True)
    links = verify(fresh, docs, id_col, text_col, width, percent)
    labels = merge(labels, written(links, "links", compact=True))
    links = _links_across(_meetings(buckets, nodes, labels), docs, id_col, text_col, width, percent)
    labels = merge(labels, written(links, "links", compact=True))
    # Copies of a set take the component of its node, one with a third of all rows as well.
    of_set = (own.join(labels, "node", "left")
              .select("digest", F.coalesce("component", "node").alias("component")))
    joined = rows.join(of_set, "digest", "left")
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(
        F.coalesce("component", "id"))
    return joined.select("id", "n_shingles", component.cast("bigint").alias("component_id"),
                         (F.col("id").isNull() | (F.col("id") == component)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, of the document that stays from each group.

    Of rows that share both id and text any one stays; different texts of an id that
    stays all stay, and so do rows without an id.
    """
    found = near_duplicates(docs, id_col, text_col, width, percent)
    flag, name, gone = unused(docs, "__perhaps", "__name", "__gone")
    # The ids that lose rows: those of other documents, and those that stand on several rows.
    named = written(found.where("id is not null").groupBy(F.col("id").alias(name))
                    .agg((~F.bool_or("kept")).alias(gone), F.count(F.lit(1)).alias("n"))
                    .where(F.col(gone) | (F.col("n") > 1)).select(name, gone), "gone")
    marked = perhaps_named(docs, id_col, named, flag)
    # Most documents are certain to stay and are not shuffled.
    stays = marked.where(~F.col(flag)).drop(flag)
    asked = (marked.where(F.col(flag)).drop(flag)
             .join(named, F.col(f"`{id_col}`") == F.col(name), "left"))
    own = [F.col(f"`{c}`") for c in docs.columns]
    once = asked.where(~F.col(gone)).select(*own).dropDuplicates([id_col, text_col])
    return (stays.unionByName(asked.where(F.col(gone).isNull()).select(*own))
            .unionByName(once))
