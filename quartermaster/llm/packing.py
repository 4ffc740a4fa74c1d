"""Best-fit packing of tokenised documents into fixed-length sequences.

Documents are tokenised where they lie; only piece descriptions (a few
numbers each) travel. Round 0 deals the pieces into partitions of about
`per_task` items; each is packed best-fit decreasing, nearly full bins are
emitted, and underfull bins go on as single items to fewer partitions, until
one partition is left or fewer partitions would exceed `per_task` items.
Every round is checkpointed, so a lost executor repeats one round only.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.llm.common import cut, map_arrow, sub_batches, texts_of, word_hashes

CHUNK = 1 << 19  # a batch takes some 40 times its bytes in arrays
CACHE_PARTS, CACHE_IDS = 300_000, 3_000_000  # then the cache starts anew; about 70 MB a Python worker
_ENCODERS: dict[str, WordEncoder] = {}


SPACE, LETTER, MARK, OTHER = range(4)


def byte_classes() -> np.ndarray:
    c = np.full(256, OTHER, np.uint8)
    c[[9, 10, 11, 12, 13, 32]] = SPACE
    c[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) != "'"]] = MARK
    c[[i for i in range(128) if chr(i).isalpha()]] = LETTER
    return c


class WordEncoder:
    """Token ids of texts by their pre-tokens, with a bounded cache.

    Only for tokenizers that lower-case, drop white space, never join what it
    separates, part letters from punctuation and mark the last token of each
    part. In words of plain letters (ASCII and U+00C0 to U+00FF) and plain
    punctuation, every run of either is a part; any other word is one part,
    encoded alone. A batch's distinct parts are found by hash in numpy; new
    parts are encoded together.
    """

    CLASSES = byte_classes()

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.specials = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self):
        self.index: dict[bytes, int] = {}
        self.start, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def store(self, parts: list[bytes], ids: np.ndarray, sizes: np.ndarray):
        n, k = len(self.index), len(parts)
        while n + k > len(self.start):
            self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.start[n:n + k] = self.used + np.cumsum(sizes) - sizes
        self.size[n:n + k] = sizes
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.index.update(zip(parts, range(n, n + k)))

    def ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def learn(self, plain: list[bytes], odd: list[bytes]):
        if plain:
            ids = np.array(self.ids(b" ".join(plain).decode()), np.uint32)
            at = np.flatnonzero(self.ends[ids]) + 1
            if len(at) != len(plain):
                raise ValueError("the tokenizer doesn't end every part with a marked token")
            self.store(plain, ids, np.diff(at, prepend=0))
        if odd:
            each = [self.ids(x.decode()) for x in odd]
            self.store(odd, np.array([i for x in each for i in x], np.uint32), np.array([len(x) for x in each]))

    def parts(self, data: np.ndarray, offs: np.ndarray):
        """Bytes with a blank after each text, lower-cased but in odd words; starts and ends of
        the parts, whether each is odd, and the text of each."""
        n = len(offs) - 1
        buf = np.full(len(data) + n, 32, np.uint8)
        buf[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offs))] = data
        kind = self.CLASSES[buf]
        lead = np.flatnonzero(buf[:-1] == 0xC3)
        second = buf[lead + 1]
        lead = lead[(second != 0x97) & (second != 0xB7)]
        kind[lead] = kind[lead + 1] = LETTER
        raw = buf.tobytes()
        for special in self.specials:  # matched by the tokenizer before anything else
            at = raw.find(special)
            while at >= 0:
                kind[at] = OTHER
                at = raw.find(special, at + 1)
        inside = kind != SPACE
        edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
        s, e = edge[0::2], edge[1::2]
        others = np.concatenate(([0], np.cumsum(kind == OTHER)))
        odd = others[e] > others[s]
        kind[np.repeat(s[odd], (e - s)[odd]) + within((e - s)[odd])] = OTHER
        capital = (kind == LETTER) & (buf >= 65) & (buf <= 90)
        capital[lead + 1] = (kind[lead + 1] == LETTER) & (buf[lead + 1] <= 0x9E)
        buf[capital] += 32
        new = np.flatnonzero(np.diff(np.concatenate(([SPACE], kind, [SPACE]))))
        s, e = new[:-1], new[1:]
        keep = kind[s] != SPACE
        s, e = s[keep], e[keep]
        text = np.searchsorted(offs[1:] + np.arange(n), s, side="right")
        return buf, s, e, kind[s] == OTHER, text

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in a row, and how many each text has."""
        if len(self.index) > CACHE_PARTS or self.used > CACHE_IDS:
            self.clear()
        buf, s, e, odd, text = self.parts(data, offs)
        if not len(s):
            return np.zeros(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
        h = word_hashes(buf, s, e)
        order = np.argsort(h)
        new = np.concatenate(([True], h[order][1:] != h[order][:-1]))
        which = np.empty(len(h), np.int64)
        which[order] = np.cumsum(new) - 1
        first = order[new]
        raw = buf.tobytes()
        parts = [raw[a:z] for a, z in zip(s[first].tolist(), e[first].tolist())]
        missing = [i for i, x in enumerate(parts) if x not in self.index]
        if missing:
            is_odd = odd[first].tolist()
            self.learn([parts[i] for i in missing if not is_odd[i]], [parts[i] for i in missing if is_odd[i]])
        at = np.fromiter(map(self.index.__getitem__, parts), np.int64, len(parts))[which]
        size = self.size[at]
        ids = self.flat[np.repeat(self.start[at], size) + within(size)]
        return ids, np.bincount(text, weights=size, minlength=len(offs) - 1).astype(np.int64)


def within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... size - 1 for each size in turn."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """id, piece, start, length, crc of every document's pieces."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        enc = encoder(tokenizer)
        enc.clear()  # nothing is kept from an earlier partition
        for b in sub_batches(batches, "text", CHUNK):
            ids, n = enc.encode(*texts_of(b.column("text")))
            ends = np.cumsum(n)
            all_ids = np.insert(ids, ends, end_id).astype("<u4")
            n = n + 1
            first = np.cumsum(n) - n
            parts = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), parts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * capacity
            length = np.minimum(capacity, n[row] - start)
            at = first[row] + start
            crc = [zlib.crc32(all_ids[a:z]) for a, z in zip(at.tolist(), (at + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                 pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "crc"])
        enc.clear()

    return map_arrow(docs, run, f"id {kind}, piece int, start bigint, length bigint, crc bigint")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin of each item, and each bin's fill."""
    bins = np.empty(len(sizes), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, fill = 0, []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        free = mask >> size
        if free:
            left = size + (free & -free).bit_length() - 1
            k = room[left].pop()
            if not room[left]:
                mask &= ~(1 << left)
        else:
            k, left = len(fill), capacity
            fill.append(0)
        bins[i] = k
        fill[k] += size
        left -= size
        if left:
            room[left].append(k)
            mask |= 1 << left
    return bins, np.array(fill, np.int64)


COLUMNS = ["id", "piece", "start", "length", "crc", "sequence_id", "offset"]


def packed_round(rows: DataFrame, number: int, parts: int, capacity: int, close_at: int) -> DataFrame:
    """Packs the items (rows sharing a sequence_id, in offset order) of each
    partition; bins filled below `close_at` stay open."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        # content order, so that a repeated task deals alike
        t = t.combine_chunks()
        seq, length = t.column("sequence_id").to_numpy(), t.column("length").to_numpy()
        item = np.cumsum(np.concatenate(([0], seq[1:] != seq[:-1])))
        bins, fill = best_fit(np.bincount(item, weights=length).astype(np.int64), capacity)
        order = np.argsort(bins[item], kind="stable")
        bin_of, length = bins[item][order], length[order]
        ends = np.cumsum(length)
        before = np.concatenate(([0], np.cumsum(fill)))[:-1]
        t = t.take(pa.array(order))
        base = (number << 56) | (TaskContext.get().partitionId() << 28)
        out = pa.Table.from_arrays(
            [t.column(c) for c in COLUMNS[:5]] + [pa.array(base + bin_of), pa.array(ends - length - before[bin_of]),
                                                  pa.array(fill[bin_of] < close_at)], COLUMNS + ["open"])
        yield from out.combine_chunks().to_batches()

    return map_arrow(rows.repartition(parts, F.xxhash64("sequence_id", F.lit(number)))
                     .sortWithinPartitions("sequence_id", "offset"), run, f"id {kind}, piece int, start bigint, length bigint, crc bigint, "
                     "sequence_id bigint, offset bigint, open boolean")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
                   end_id: int = 0, nearly_full: float = 0.99, per_task: int = 20_000, fan_in: int = 8) -> DataFrame:
    """Packs all documents into sequences of at most `capacity` tokens.

    A document is its token ids followed by `end_id`; longer documents alone
    are cut, into pieces of `capacity` tokens. Returns one row for each
    piece: `id_col`, piece (from 0), start (the document's tokens before
    it), length, ids_crc32 (little-endian unsigned 32-bit ids), sequence_id,
    offset (place in the sequence, without gaps).

    Null and empty texts are one token, `end_id`; rows that share an id, or
    are equal, are packed as separate documents; an empty table gives an
    empty result; other columns are not read, whatever their names. Texts of
    any length are whole; partitions may be empty.
    """
    pieces = cut(token_pieces(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), tokenizer, capacity, end_id))
    # every piece starts as an item of its own; equal numbers would only join rows of one item
    rows = cut(pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("bigint")))
    full = F.col("length") >= capacity
    done = rows.filter(full).select(*COLUMNS)
    rows = rows.filter(~full)
    n = rows.count()
    parts, number = max(1, -(-n // per_task)), 1
    while True:
        packed = cut(packed_round(rows.select(*COLUMNS), number, parts, capacity, round(nearly_full * capacity)))
        open_ = packed.filter("open")
        left = open_.select("sequence_id").distinct().count()
        fewer = max(1, -(-parts // fan_in), -(-left // per_task))
        if parts == 1 or fewer >= parts or not left:
            done = done.union(packed.select(*COLUMNS))
            break
        done = done.union(packed.filter("NOT open").select(*COLUMNS))
        rows, parts, number = open_, fewer, number + 1
    return done.select(F.col("id").alias(id_col), "piece", "start", "length", F.col("crc").alias("ids_crc32"),
                       "sequence_id", "offset")
