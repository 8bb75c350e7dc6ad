"""Byte-pair encoding and decoding with a published vocabulary of word-end BPE.

``encode`` normalises, cuts and merges as the vocabulary file says, ``decode`` joins token
texts. A piece is encoded on a contiguous rank array: the parts of the piece and, beside
them, the merge rank of every adjacent pair. The least rank is found by a scan, its
boundary is deleted and the two neighbouring ranks are looked up again. That is the
fastest way for short words; pieces of more than ``LONG_PIECE`` symbols take the same
merges from a heap instead, since scanning them would take quadratic time.

Both are map-only: no shuffle, and the encoder itself (a few MB of fixed size) is the only
broadcast. Texts of assigned characters (Unicode 15.1) come out as the tokenizers library
has them; letters newer than that may be cut in other places. Token ids are packed as little-endian unsigned 32-bit integers, the layout of
token files for training.

Defined results: a null text is an empty one, which has no tokens and decodes to ""; null
packed ids stay null on decoding; repeated rows and ids are encoded each for itself; very long texts
are encoded whole; an empty table gives no rows. Columns are named by the caller and no
others are read, so clashing names cannot matter.
"""

from __future__ import annotations

import heapq
import json
import struct
import unicodedata
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, slices, utf8

#: Words a worker remembers; then it starts afresh.
CACHE_WORDS = 1 << 17
#: Symbols above which a piece is merged by a heap.
LONG_PIECE = 256

#: Control characters that split() takes for white space and the vocabulary's pattern doesn't.
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


def byte_symbols() -> list[str]:
    """The printable symbol of each byte, as byte-level vocabularies spell it.

    Printable Latin-1 bytes stand for themselves, the others for the code points
    from 256 upwards in order.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class WordEndBpe:
    """The vocabulary: token ids, merge ranks and the cutting rules of its file."""

    def __init__(self, spec: dict):
        import regex

        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.texts = {i: t for t, i in (self.ids | self.special).items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: (left id, right id) -> (rank, merged id)
        self.merges = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b])
                       for rank, (a, b) in enumerate(merges)}
        symbols = byte_symbols()
        self.byte_ids = [self.ids[s] for s in symbols]
        self.last_ids = [self.ids[s + self.suffix] for s in symbols]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"]
                       if p["type"] == "Split")
        self.cut = regex.compile(pattern).findall
        self.split_special = regex.compile(
            "(" + "|".join(map(regex.escape, self.special)) + ")").split
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.words: dict[str, tuple[int, ...]] = {}

    @classmethod
    def from_file(cls, path: str) -> WordEndBpe:
        with open(path, encoding="utf-8") as file:
            return cls(json.load(file))

    def _symbols(self, piece: str) -> list[int]:
        data = piece.encode()
        parts = [self.byte_ids[b] for b in data]
        parts[-1] = self.last_ids[data[-1]]
        return parts

    def merge(self, piece: str) -> tuple[int, ...]:
        """Token ids of one piece, by the contiguous rank array."""
        parts = self._symbols(piece)
        if len(parts) > LONG_PIECE:
            return self.merge_long(parts)
        none = (1 << 60, -1)
        find = self.merges.get
        ranks = [find(pair, none) for pair in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best is none:
                break
            i = ranks.index(best)
            parts[i] = best[1]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = find((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = find((parts[i], parts[i + 1]), none)
        return tuple(parts)

    def merge_long(self, parts: list[int]) -> tuple[int, ...]:
        """The same merges in the same order, n log n: linked parts and a heap."""
        n = len(parts)
        after = [*range(1, n), -1]
        before = [*range(-1, n - 1)]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (found := self.merges.get((parts[i], parts[j]))):
                heapq.heappush(heap, (found[0], i, parts[i], parts[j], found[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue
            parts[i], parts[j] = merged, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return tuple(p for p in parts if p >= 0)

    def word(self, word: str) -> tuple[int, ...]:
        """Token ids of a run without white space, already normalised."""
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        if len(self.pieces) >= CACHE_WORDS:
            self.pieces.clear()
        found: list[int] = []
        for piece in self.cut(word):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self.merge(piece)
                if len(piece) <= LONG_PIECE:
                    self.pieces[piece] = ids
            found += ids
        out = tuple(found)
        if len(word) <= LONG_PIECE:
            self.words[word] = out
        return out

    def encode(self, text: str) -> list[int]:
        if "<|" in text and any(s in text for s in self.special):
            spans = self.split_special(text)
        else:
            spans = [text]
        ids: list[int] = []
        known = self.words.get
        for span in spans:
            if span in self.special:
                ids.append(self.special[span])
                continue
            if not span.isascii():
                span = unicodedata.normalize("NFC", span)
                # Letter by letter: a capital sigma that ends a word is not special.
                span = span.replace("Σ", "σ")
            span = span.lower()
            words = span.split()
            if any(s in span for s in _SEPARATORS):
                words = [span]
            for word in words:
                found = known(word)
                ids += self.word(word) if found is None else found
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        """Token texts joined by spaces; the file names no decoder. Unknown ids are left out."""
        texts = self.texts
        return " ".join([texts[i] for i in ids if i in texts])


def share(spark: SparkSession, path: str):
    """Read the vocabulary on the driver, where ``path`` is, and broadcast it."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast({"file": file.read()})


def _loaded(shared) -> WordEndBpe:
    """The encoder of this Python worker, kept beside the broadcast between tasks."""
    held = shared.value
    if "encoder" not in held:
        held["encoder"] = WordEndBpe(json.loads(held["file"]))
    return held["encoder"]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(df: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, n_tokens, token_ids) of every text; ids are packed, four bytes each."""
    shared = share(df.sparkSession, vocabulary or default_vocabulary())

    def run(batches):
        import pyarrow as pa

        bpe = _loaded(shared)
        for keys, texts in slices(batches):
            ids = [bpe.encode(t.decode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([struct.pack(f"<{len(x)}I", *x) for x in ids], pa.binary())],
                names=["id", "n_tokens", "token_ids"])

    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), utf8(text_col).alias("text"))
    return bounded(rows).mapInArrow(run, "id bigint, n_tokens bigint, token_ids binary")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The columns of ``encode`` and the text its packed ids stand for."""
    shared = share(encoded.sparkSession, vocabulary or default_vocabulary())

    def run(batches):
        import pyarrow as pa

        bpe = _loaded(shared)
        for keys, counts, packed in slices(batches):
            texts = [None if p is None else bpe.decode(memoryview(p).cast("I")) for p in packed]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(packed, pa.binary()), pa.array(texts, pa.string())],
                names=["id", "n_tokens", "token_ids", "decoded"])

    rows = encoded.select("id", "n_tokens", "token_ids")
    return bounded(rows).mapInArrow(run, "id bigint, n_tokens bigint, token_ids binary, decoded string")


def round_trip(df: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """What ``decode(encode(df))`` gives, with one Python worker and one encoder per task."""
    shared = share(df.sparkSession, vocabulary or default_vocabulary())

    def run(batches):
        import pyarrow as pa

        bpe = _loaded(shared)
        for keys, texts in slices(batches):
            ids = [bpe.encode(t.decode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([struct.pack(f"<{len(x)}I", *x) for x in ids], pa.binary()),
                 pa.array([bpe.decode(x) for x in ids], pa.string())],
                names=["id", "n_tokens", "token_ids", "decoded"])

    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), utf8(text_col).alias("text"))
    return bounded(rows).mapInArrow(
        run, "id bigint, n_tokens bigint, token_ids binary, decoded string")
