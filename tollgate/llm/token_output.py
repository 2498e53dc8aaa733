"""Token-id output as directly addressable codes.

Documents are range-partitioned and sorted by doc_id (ties by a hash of the
text), tokenised, closed with an end id and written as segments of about
``SEGMENT_TOKENS`` ids: one row of a Parquet table for each segment, holding
the ``DAC1`` payload and the ids and lengths of its documents.  Parquet rows
are the container because only Spark's writers reach every store.  A segment
knows how many ids of its partition precede it; partition totals (one row per
partition) give the global start, so that token i of the corpus is found from
a segment's start and read with ``dac.Reader``.

Files are in order of doc_id whatever order the documents are to be read in.
``ordered_output`` takes that order from the files that hold the documents and
writes, beside the segments, an index sorted by it (``rank``, from 0, with
doc_id, start, n_tokens and ids_crc32).

The tokenizer runs on words: a byte-level BPE with the usual pattern never
joins text across "non-space, space, non-space" or "non-space, line feed,
non-space".  In a text of single blanks and line feeds the words of a batch are
hashed as bytes in one go, each new one is encoded once per worker, and the ids
are gathered from memory (``MEMORY_IDS`` ids at most; then the words that were
met again stay and the others go).
Texts with other white space, or with very long words, are cut where that is
safe and encoded by themselves.

Defined cases: a NULL or empty text is the end id alone; a NULL doc_id comes
first; repeated ids and rows are encoded each; an empty table gives no rows; a
very long text is one document of one segment.  The strings of added tokens
(``<|endoftext|>``) inside a text become those tokens, as the library does it;
an ``Encoder`` told ``specials_as_text`` takes them as ordinary text.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.llm import dac
from tollgate.llm.common import python_tasks, read_table, stage_path
from tollgate.llm.textvec import KEPT, byte_class, give_back, mix, ranges, start_over, text_bytes, word_hashes, word_spans

END_ID = 2
SEGMENT_TOKENS = 1 << 16
#: Ids that the memory for words holds, bytes of a word kept there, entries of
#: its quick table, and bytes of text worked on at once.
MEMORY_IDS, WORD_BYTES, QUICK, PIECE_BYTES = 3_000_000, 256, 1 << 18, 1 << 18
SEGMENTS = ("part int, seq int, part_start bigint, n_tokens bigint, doc_ids array<bigint>, "
            "doc_tokens array<bigint>, doc_ranks array<bigint>, payload binary")
DIGEST = "part int, doc_id bigint, rank bigint, offset bigint, n_tokens bigint, ids_crc32 bigint"
INDEX = "rank bigint, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
_CUT = re.compile(r"(?<=\S)(?= \S)")
_PUNCTUATION = ".,!?;:"


#: Bytes of an Arrow batch of texts: small, since ids and the memory for words stand beside it.
TEXT_BATCH = 4 << 20


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


_WORD = byte_class(b" \n")
#: Bytes that make a text irregular, and the first two bytes of white space
#: beyond ASCII (of more characters than that, which does no harm).
_ODD = ~byte_class(bytes([9, 11, 12, 13, 28, 29, 30, 31]))
_LEAD = ~byte_class(bytes([0xC2, 0xE1, 0xE2, 0xE3]))
_PAIRS = np.array([0xC285, 0xC2A0, 0xE19A, 0xE280, 0xE281, 0xE380])
#: What tells words after a line feed, and closing punctuation, from words after a space.
_KINDS = np.array([0, 0xA24BAED4963EE407, 0x9FB21C651E98DF25], np.uint64)
_AFTER_SPACE, _AFTER_FEED, _CLOSING = range(3)
#: What stands for each byte in the vocabulary of a byte-level BPE.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = np.arange(256, dtype="<u4")
_BYTE_CHARS[sorted({*range(256)} - {*_SHOWN})] = np.arange(256, 512 - len(_SHOWN))
_MARK, _LETTER = ~byte_class(_PUNCTUATION.encode()), ~byte_class(bytes([*range(65, 91), *range(97, 123)]))
LEARN_WORDS = 4096


class Encoder:
    """``tokenizers`` with a memory for words; ids as little-endian u32.

    A key is a word that stands after one space, or, with a leading line feed,
    one that stands after a line feed.  A text's first word is looked up as if
    after a line feed, whose id is then left out.  Words are known by a 64-bit
    hash and their length in bytes."""

    def __init__(self, path: str, specials_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = specials_as_text
        self.added = [] if specials_as_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.width[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.feed, *tails = self._raw(["\n", *_PUNCTUATION])
        self.tails = dict(zip(_PUNCTUATION, tails))
        before = self.tokenizer.pre_tokenizer
        self.model = self.tokenizer.model if self.tokenizer.normalizer is None and isinstance(before, ByteLevel) and before.use_regex else None
        self._forget()

    def _forget(self) -> None:
        self.quick_hash, self.quick_entry = np.zeros(QUICK, np.uint64), np.full(QUICK, -1, np.int32)
        self.known_hash, self.known_entry = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.ids, self.first = np.zeros(0, np.uint16 if len(self.width) <= 1 << 16 else np.uint32), np.zeros(1, np.int32)
        self.bytes = np.zeros(0, np.uint16)  # words of at most WORD_BYTES
        self.again = np.zeros(0, bool)  # met again since they were learned or last kept

    def _make_room(self, ids: int) -> None:
        """Words that were not met again go, or all if the others leave no room."""
        stay = self.again
        counts = np.diff(self.first)
        if int(counts[stay].sum()) + ids > MEMORY_IDS:
            return self._forget()
        entry = np.where(stay, np.cumsum(stay, dtype=np.int32) - 1, np.int32(-1)).astype(np.int32)
        known = stay[self.known_entry]
        self.known_hash, self.known_entry = self.known_hash[known], entry[self.known_entry[known]]
        self.quick_entry = np.where(self.quick_entry >= 0, entry[self.quick_entry], np.int32(-1))
        self.ids = self.ids[np.repeat(stay, counts)]
        self.first = np.concatenate([[0], np.cumsum(counts[stay])]).astype(np.int32)
        self.bytes, self.again = self.bytes[stay], np.zeros(int(stay.sum()), bool)

    def _raw(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _letters(self, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Words of ``text`` of nothing but letters (ASCII, Latin-1) behind their
        blank: the tokenizer's pattern leaves each whole, so the model alone
        gives its ids."""
        latin = np.zeros(len(text), bool)
        latin[1:] = (text[:-1] == 0xC3) & (text[1:] != 0x97) & (text[1:] != 0xB7)
        other = np.cumsum(~(_LETTER[text] | latin | (text == 0xC3)))
        # The blank is the one other byte.
        return np.diff(other[ends - 1], prepend=0) == 1

    def _modelled(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
        shown, tokenize, ids, counts = _BYTE_CHARS[text].tobytes().decode("utf-32-le"), self.model.tokenize, [], []
        spans = list(zip(starts.tolist(), ends.tolist()))
        for k in range(0, len(spans), LEARN_WORDS):
            found = [tokenize(shown[a:b]) for a, b in spans[k: k + LEARN_WORDS]]
            ids += [t.id for tokens in found for t in tokens]
            counts += map(len, found)
        return ids, counts

    def _whole(self, text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Many words as one text, whose ids are dealt back by their width in bytes."""
        ids = np.array(self.tokenizer.encode_batch_fast([text.tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
        reached = np.cumsum(self.width[ids])
        cuts = np.searchsorted(reached, ends) + 1
        if reached[-1] != ends[-1] or (reached[cuts - 1] != ends).any():
            raise ValueError("a token crosses a word boundary")
        return ids, np.diff(cuts, prepend=0)

    def _learned(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of words, each behind its blank: those of
        letters behind a space go to the tokenizer's model one by one, the others
        through the tokenizer as one text."""
        size = ends - starts + 1
        last = np.cumsum(size)
        first = last - size
        text = np.empty(int(last[-1]), np.uint8)
        text[first] = np.where(kind == _AFTER_FEED, 10, 32)
        text[ranges(first + 1, size - 1)] = raw[ranges(starts, size - 1)]
        alone = (kind == _AFTER_SPACE) & self._letters(text, last) if self.model else np.zeros(len(size), bool)
        counts = np.zeros(len(size), np.int64)
        parts = []
        ids, counts[alone] = self._modelled(text, first[alone], last[alone])
        parts.append(np.array(ids, np.uint32))
        rest = np.flatnonzero(~alone)
        for k in range(0, len(rest), LEARN_WORDS):
            some = rest[k: k + LEARN_WORDS]
            ids, counts[some] = self._whole(text[ranges(first[some], size[some])], np.cumsum(size[some]))
            parts.append(ids)
        # The words' own order again.
        order = np.concatenate([np.flatnonzero(alone), rest])
        at = np.empty(len(size), np.int64)
        at[order] = np.cumsum(counts[order]) - counts[order]
        ids = np.concatenate(parts)[ranges(at, counts)]
        closing = kind == _CLOSING
        if closing.any():  # encoded behind a blank above, but they stand behind a letter
            own = np.array([np.frombuffer(self.tails[chr(b)], "<u4")[0] for b in raw[starts[closing]].tolist()], np.uint32)
            at = np.cumsum(counts) - counts
            drop = ranges(at[closing] + 1, counts[closing] - 1)
            ids[at[closing]] = own
            ids, counts = np.delete(ids, drop), np.where(closing, 1, counts)
        return ids, counts

    def _alone(self, text: str) -> bytes:
        """A text by itself: cut only where that is safe."""
        if any(t in text for t in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(self._raw(_CUT.split(text)))

    def _entries(self, h: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Where each word's ids are remembered; new words are encoded."""
        slot = h & np.uint64(QUICK - 1)
        entry = self.quick_entry[slot]
        hit = (self.quick_hash[slot] == h) & (entry >= 0)
        self.again[entry[hit]] = True
        missed = np.flatnonzero(~hit)
        if len(missed) == 0:
            return entry
        distinct, at, back = np.unique(h[missed], return_index=True, return_inverse=True)
        place = np.searchsorted(self.known_hash, distinct)
        near = np.minimum(place, max(len(self.known_hash) - 1, 0))
        is_known = self.known_hash[near] == distinct if len(self.known_hash) else np.zeros(len(distinct), bool)
        found = np.where(is_known, self.known_entry[near], np.int32(-1)) if len(self.known_hash) else np.full(len(distinct), -1, np.int32)
        self.again[found[is_known]] = True
        new = np.flatnonzero(~is_known)
        if len(new):
            if len(self.bytes) and len(self.ids) + 4 * len(new) > MEMORY_IDS:
                self._make_room(4 * len(new))
                return self._entries(h, raw, starts, ends, kind)
            where = missed[at[new]]
            ids, counts = self._learned(raw, starts[where], ends[where], kind[where])
            found[new] = np.arange(len(self.bytes), len(self.bytes) + len(new))
            self.known_hash = np.insert(self.known_hash, place[new], distinct[new])
            self.known_entry = np.insert(self.known_entry, place[new], found[new])
            self.first = np.concatenate([self.first, (self.first[-1] + np.cumsum(counts)).astype(np.int32)])
            self.ids = np.concatenate([self.ids, ids.astype(self.ids.dtype)])
            self.bytes = np.concatenate([self.bytes, (ends[where] - starts[where]).astype(np.uint16)])
            self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
        slot = distinct & np.uint64(QUICK - 1)
        self.quick_hash[slot], self.quick_entry[slot] = distinct, found
        entry[missed] = found[back]
        return entry

    def _odd(self, column: pa.Array, raw: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Texts to be encoded by themselves."""
        odd = np.zeros(len(offsets) - 1, bool)
        if len(raw) == 0:
            return odd
        blank = ~_WORD[raw]
        lead = np.flatnonzero(_LEAD[raw[:-1]])
        pairs = raw[lead].astype(np.int64) << 8 | raw[lead + 1]
        full = np.flatnonzero(offsets[1:] > offsets[:-1])
        at = np.concatenate([np.flatnonzero(_ODD[raw]), np.flatnonzero(blank[1:] & blank[:-1]), lead[np.isin(pairs, _PAIRS)], starts[ends - starts > WORD_BYTES]])
        odd[np.searchsorted(offsets, at, "right") - 1] = True
        odd[full] |= blank[offsets[full]] | blank[offsets[full + 1] - 1]
        for t in self.added:
            odd |= pc.fill_null(pc.match_substring(column, t), False).to_numpy(zero_copy_only=False)
        return odd

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        raw, offsets = text_bytes(column)
        starts, ends, first_word = word_spans(raw, offsets, _WORD)
        odd = self._odd(column, raw, offsets, starts, ends)
        doc = np.repeat(np.arange(len(odd)), np.diff(first_word))
        # Closing punctuation after a letter is a token of its own.
        cut = np.flatnonzero((ends - starts > 1) & _MARK[raw[ends - 1]] & _LETTER[raw[np.maximum(ends - 2, 0)]]) if len(raw) else np.zeros(0, np.int64)
        leads = starts == offsets[doc]
        kind = np.where(leads | (raw[np.maximum(starts - 1, 0)] == 10), _AFTER_FEED, _AFTER_SPACE) if len(raw) else np.zeros(0, np.int64)
        mark = ends[cut] - 1
        ends = ends.copy()
        ends[cut] = mark
        starts, ends, doc, kind, leads = (np.insert(c, cut + 1, v) for c, v in ((starts, mark), (ends, mark + 1), (doc, doc[cut]), (kind, _CLOSING), (leads, False)))
        while True:
            kept = np.flatnonzero(~odd[doc])
            a, b, of, k = starts[kept], ends[kept], doc[kept], kind[kept]
            h = word_hashes(raw, a, b)
            h = np.where(k == _AFTER_SPACE, h, mix(h + _KINDS[k]))
            entry = self._entries(h, raw, a, b, k)
            other = self.bytes[entry] != b - a
            if not other.any():
                break
            odd[of[other]] = True  # another word of the same hash
        skip = np.where(leads[kept], len(self.feed) // 4, 0)
        begin = self.first[entry].astype(np.int64) + skip
        length = self.first[entry + 1] - begin
        ids = self.ids[ranges(begin, length)].astype(np.uint32)
        counts = np.bincount(of, length, len(odd)).astype(np.int64)
        if odd.any():
            parts, at, before = [], 0, 0
            for k in np.flatnonzero(odd).tolist():
                alone = np.frombuffer(self._alone(column[k].as_py()), "<u4")
                upto = at + int(counts[before:k].sum())
                parts += [ids[at:upto], alone]
                counts[k], at, before = len(alone), upto, k + 1
            ids = np.concatenate([*parts, ids[at:]])
        return ids, counts

    def encode(self, texts: list[str | None]) -> list[bytes]:
        ids, counts = self.encode_column(pa.array(texts, pa.string()))
        raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        return [raw[b - 4 * n: b] for b, n in zip(ends, counts.tolist())]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}
KEPT.append(_ENCODERS)


def encoder(path: str, specials_as_text: bool = False) -> Encoder:
    """One per Python worker."""
    key = path, specials_as_text
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, specials_as_text)
    return _ENCODERS[key]


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most about ``PIECE_BYTES`` of text, or one longer text."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64()))
    group = (np.cumsum(size) - 1) // PIECE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _segments(path: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what earlier tasks of this worker held
        enc, part = encoder(path), TaskContext.get().partitionId()
        held, count, seq, before = [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            ids, lengths, ranks, tokens = zip(*held)
            ids, ranks, lengths, tokens = pa.concat_arrays(ids), pa.concat_arrays(ranks), np.concatenate(lengths), np.concatenate(tokens)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before]), pa.array([len(tokens)]),
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([lengths], pa.list_(pa.int64())),
                 pa.ListArray.from_arrays(pa.array([0, len(ranks)], pa.int32()), ranks), pa.array([dac.encode(tokens)], pa.binary())],
                ["part", "seq", "part_start", "n_tokens", "doc_ids", "doc_tokens", "doc_ranks", "payload"])
        for batch in batches:
            for piece in _pieces(batch, 1):
                ids, counts = enc.encode_column(piece.column(1))
                tokens = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
                counts = counts + 1
                ends = np.cumsum(counts)
                a = 0
                while a < len(counts):
                    # Documents up to the one that fills the segment.
                    gone = int(ends[a] - counts[a])
                    b = min(len(counts), a + 1 + int(np.searchsorted(ends[a:] - gone, SEGMENT_TOKENS - count)))
                    held.append((piece.column(0).slice(a, b - a), counts[a:b], piece.column(2).slice(a, b - a), tokens[gone: int(ends[b - 1])]))
                    count += int(ends[b - 1]) - gone
                    if count >= SEGMENT_TOKENS:
                        yield flush()
                        seq, before = seq + 1, before + count
                        held, count = [], 0
                    a = b
        if held:
            yield flush()
        give_back()
    return write


def file_ranks(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``rank``: the row's place, from 0, in the Parquet files
    ``docs`` is read from, in the order of the tasks that wrote them.  Summed
    is one row for each file."""
    meta = docs.metadataColumn("_metadata")
    rows = docs.select("doc_id", "text", meta["file_name"].alias("file"), meta["row_index"].alias("row_index"))

    def number(pattern):
        return F.coalesce(F.regexp_extract("file", pattern, 1).try_cast("bigint"), F.lit(0))
    order = Window.orderBy(number("^part-([0-9]+)"), number("-c([0-9]+)[.]"), "file")
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    files = files.select("file", (F.sum("n").over(order) - F.col("n")).alias("ahead"))
    return rows.join(F.broadcast(files), "file").select("doc_id", "text", (F.col("ahead") + F.col("row_index")).alias("rank"))


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> str:
    """Write ``docs`` (doc_id, text, and rank if they have one) as DAC segments;
    returns the folder."""
    spark = docs.sparkSession
    # The place of reading spreads equal rows over ranges; a rank is such a place already.
    rank, read = (docs["rank"], F.lit(0)) if "rank" in docs.columns else (F.lit(None), F.monotonically_increasing_id())
    python_tasks(spark, TEXT_BATCH)
    path = stage_path(spark, "tokens")
    ordered = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"), F.xxhash64(docs["text"]).alias("tie"), rank.cast("bigint").alias("rank"), read.alias("read"))
    keys = ["doc_id", "tie", "rank", "read"]
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text", "rank")
    ordered.mapInArrow(_segments(tokenizer, end_id), SEGMENTS).write.parquet(path)
    return path


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    start_over()  # reading needs no tokenizer
    for batch in batches:
        for row in batch.to_pylist():
            raw = dac.Reader(row["payload"]).decode().astype("<u4").tobytes()
            lengths = np.array(row["doc_tokens"], np.int64)
            ends = np.cumsum(lengths)
            view = memoryview(raw)
            crc = [zlib.crc32(view[4 * (e - n): 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(lengths), row["part"], np.int32)), pa.array(row["doc_ids"], pa.int64()), pa.array(row["doc_ranks"], pa.int64()),
                 pa.array(row["part_start"] + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                ["part", "doc_id", "rank", "offset", "n_tokens", "ids_crc32"])
    give_back()


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The written segments with their place in the corpus (column ``base``:
    ids of all partitions before).  The running sum is over one row for each
    partition."""
    table = spark.read.schema(SEGMENTS).parquet(path)
    totals = table.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    order = Window.orderBy("part")
    bases = totals.select("part", (F.sum("total").over(order) - F.col("total")).alias("base"))
    return table.join(bases, "part")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32, rank."""
    table = spark.read.schema(SEGMENTS).parquet(path)
    totals = table.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    bases = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    found = table.select("part", "part_start", "doc_ids", "doc_tokens", "doc_ranks", "payload").mapInArrow(_digests, DIGEST)
    return found.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "rank")


def token_output(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write, then read back."""
    return read_digests(docs.sparkSession, write_tokens(docs.select("doc_id", "text"), tokenizer or tokenizer_path(), end_id)).drop("rank")


def index_path(path: str) -> str:
    """Where the index by rank of the segments in ``path`` is."""
    return f"{path}-by-rank"


def ordered_output(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the segments and their index by rank, and return the index; ``docs``
    is read from Parquet files whose order is the one to keep."""
    spark = docs.sparkSession
    path = write_tokens(file_ranks(docs), tokenizer or tokenizer_path(), end_id)
    found = read_digests(spark, path).select("rank", "doc_id", "start", "n_tokens", "ids_crc32")
    found.repartitionByRange("rank").sortWithinPartitions("rank").write.parquet(index_path(path))
    return spark.read.schema(INDEX).parquet(index_path(path))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
