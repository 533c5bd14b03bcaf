"""Packing by power-of-two decomposition: every document is cut into pieces of binary lengths.

A document of n tokens gives as many pieces of the greatest length as fit, then one piece for each bit
of the rest. A piece is a sequence of its own, so no sequence crosses documents and none is padded.
Sequences of one length are numbered together in a seeded shuffle, ready to be batched by length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, compress, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from stockcast.llm.order import bucket_bits, hash_bucket, with_positions
from stockcast.llm.worker import give_back, keep
from stockcast.session import write_stage

MAX_LENGTH = 2048
END_ID = 1
SEED = 42
CACHE_SIZE = 250_000   # units a worker keeps, and as many that it has not used of late
JOINED = 500           # new units that are encoded as one text
CACHED_CHARS = 64      # longer units are encoded each time
BYTES_AT_ONCE = 4 << 20  # of texts that are encoded together
#: White space as the byte-level tokenizer's own pattern sees it: fixed values.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
RARE_ASCII = [c for c in WHITE if c.isascii() and c not in " \n"]
RARE = re.compile("[" + WHITE.replace(" ", "").replace("\n", "") + "]")
#: Marks that the tokenizer's own pattern always parts from letters before them: fixed values.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
UNITS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


def _plain(text: str) -> bool:
    """True if every white space in a text is one space or line break between other characters."""
    if text[-1] in " \n" or text[0] in " \n" or "  " in text:
        return False
    if "\n" in text and ("\n " in text or " \n" in text or "\n\n" in text):
        return False
    return not (any(c in text for c in RARE_ASCII) if text.isascii() else RARE.search(text))


def _listed(keys: pa.StringArray) -> list[str]:
    return keys.to_numpy(zero_copy_only=False).tolist()


class _Known:
    """Ids by unit, in two generations; a new one starts once there are more than ``size`` units."""

    def __init__(self) -> None:
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def find(self, keys: list[str], size: int, encode: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Ids of distinct keys. Unknown ones are encoded, and kept unless they are long."""
        if len(self.now) > size:
            self.old, self.now = self.now, {}
        found = list(map(self.now.get, keys))
        absent = [i for i, ids in enumerate(found) if ids is None]
        before = list(map(self.old.get, [keys[i] for i in absent]))
        fresh = [i for i, ids in zip(absent, before) if ids is None]
        for places, new in (absent, before), (fresh, encode([keys[i] for i in fresh])):
            for i, ids in zip(places, new):
                found[i] = ids
        self.now.update((keys[i], found[i]) for i in absent if len(keys[i]) <= CACHED_CHARS)
        return found


def _gather(table: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The table's pieces of the given sizes in the order of ``rows``, and where each begins (and the last ends).

    A batch holds under 2 GiB of text, so places of ids fit 32 bits.
    """
    n = sizes[rows]
    borders = np.append(np.int32(0), np.cumsum(n, dtype=np.int32))
    at = np.repeat((np.cumsum(sizes, dtype=np.int32) - sizes)[rows] - borders[:-1], n)
    at += np.arange(len(at), dtype=np.int32)
    return table[at], borders


class UnitCache:
    """Ids of a byte-level BPE by units: white space with the word behind it.

    The tokenizer's pattern never joins a character with white space behind it, so ids of units add up
    to the ids of the text. Keys without white space in front stand for one space and the key.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.ids, self.started, self.marks = Tokenizer.from_file(path), _Known(), _Known(), {}
        ids = range(self.tokenizer.get_vocab_size())
        # a token that begins with a space or a line break begins a unit
        self.begins = np.array([(self.tokenizer.id_to_token(i) or "")[:1] in "ĠĊ" for i in ids])

    def units(self, text: str) -> list[str]:
        """Keys of all units; the first is the beginning as it stands (empty if the text begins with white space)."""
        units = UNITS.findall(text)
        keys = [u[1:] if u[0] == " " and len(u) > 1 and u[1] not in WHITE else u for u in units]
        return ["", *keys] if units[0][0] in WHITE else [units[0], *keys[1:]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as little-endian unsigned 32-bit numbers.

        Units are numbered first, so each distinct one is looked up once; arrays then put the ids together.
        """
        plain = [not t or len(t) <= BYTES_AT_ONCE and _plain(t) for t in texts]
        split = pc.split_pattern(pc.replace_substring(pa.array(compress(texts, plain), pa.string()), "\n", " \n"), " ")
        odd = [self.units(t) for t, p in zip(texts, plain) if not p]  # behind plain ones from here on
        flat = pa.chunked_array([split.flatten(), pa.array(list(chain.from_iterable(odd)), pa.string())])
        coded = flat.combine_chunks().dictionary_encode()
        keys, codes = coded.dictionary, coded.indices.to_numpy()
        del flat
        ends = np.cumsum(np.append(pc.list_value_length(split).to_numpy(), [len(u) for u in odd]).astype(np.int64))
        begins = np.append(0, ends[:-1])

        later = np.ones(len(codes), dtype=bool)
        later[begins] = False
        used = np.bincount(codes[later], minlength=len(keys)) > 0
        firsts, places = np.unique(codes[begins], return_inverse=True)
        rows = (np.cumsum(used, dtype=np.int32) - 1)[codes]
        rows[begins] = np.count_nonzero(used) + places
        behind, sizes = self._table(self.ids, keys.filter(pa.array(used)), CACHE_SIZE, self._encode_behind)
        ahead, more = self._table(self.started, keys.take(pa.array(firsts)), CACHE_SIZE // 4, self._encode)
        ids, borders = _gather(np.append(behind, ahead), np.append(sizes, more), rows)
        out = [b""] * len(texts)
        order = np.argsort(~np.array(plain, dtype=bool), kind="stable").tolist()
        for i, a, b in zip(order, borders[begins].tolist(), borders[ends].tolist()):
            out[i] = ids[a:b].tobytes()
        return out

    def _table(
        self, known: _Known, keys: pa.StringArray, size: int, encode: Callable[[list[str]], list[bytes]]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all keys, one behind the other, and how many each has.

        Letters with marks behind them have the letters' ids and the marks' ids, so only letters are kept.
        """
        letters = pc.utf8_rtrim(keys, MARKS)
        apart = pc.and_not(pc.and_(pc.less(pc.binary_length(letters), pc.binary_length(keys)), pc.utf8_is_alpha(letters)),
                           pc.match_substring_regex(letters, "[^\\x{0}-\\x{2FFF}]"))
        heads = pc.if_else(apart, letters, keys).dictionary_encode()
        marks = [k[n:] for k, n in zip(_listed(keys.filter(apart)), pc.utf8_length(letters.filter(apart)).to_pylist())]
        tails = {mark: i for i, mark in enumerate(dict.fromkeys(marks))}
        new = [mark for mark in tails if mark not in self.marks]
        self.marks.update(zip(new, self._encode(new)))
        found = known.find(_listed(heads.dictionary), size, encode)
        parts = np.full((len(keys), 2), len(found) + len(tails), dtype=np.int32)
        parts[:, 0] = heads.indices.to_numpy()
        parts[apart.to_numpy(zero_copy_only=False), 1] = [len(found) + tails[mark] for mark in marks]
        found += [*(self.marks[mark] for mark in tails), b""]
        if len(self.marks) > CACHE_SIZE // 10:
            self.marks.clear()
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
        ids, borders = _gather(np.frombuffer(b"".join(found), "<u4"), sizes, parts.ravel())
        return ids, np.diff(borders[::2])

    def _encode(self, keys: list[str]) -> list[bytes]:
        """Ids of texts, each on its own. The tokenizer's results are large, so few are held at a time."""
        out: list[bytes] = []
        for low in range(0, len(keys), JOINED):
            found = self.tokenizer.encode_batch_fast(keys[low:low + JOINED], add_special_tokens=False)
            out += [np.array(e.ids, dtype="<u4").tobytes() for e in found]
        return out

    def _encode_behind(self, keys: list[str]) -> list[bytes]:
        """Ids of units behind others. Those of one white-space character and a word are joined to texts whose units they are."""
        full = [k if k[0] in WHITE else " " + k for k in keys]
        short = [len(k) > 1 and k[0] in " \n" and k[1] not in WHITE for k in full]
        out: list[bytes] = [b""] * len(keys)
        places = [i for i, joined in enumerate(short) if not joined]
        for i, ids in zip(places, self._encode([full[i] for i in places])):
            out[i] = ids
        places = list(compress(range(len(keys)), short))
        for part in (places[low:low + JOINED] for low in range(0, len(places), JOINED)):
            raw, = self._encode(["".join([full[i] for i in part])])
            ids = np.frombuffer(raw, "<u4")
            borders = (4 * np.append(np.flatnonzero(self.begins[ids]), len(ids))).tolist()
            if len(borders) != len(part) + 1:
                raise ValueError("the tokenizer does not begin a token at white space")
            for i, a, b in zip(part, borders, borders[1:]):
                out[i] = raw[a:b]
        return out


def portions(texts: pa.StringArray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``size`` bytes: at most that much lies before the last one."""
    n_bytes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
    part = (np.cumsum(n_bytes) - n_bytes) // size
    return pairwise([*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(texts)])


def cuts(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: ``longest`` as often as it fits, then the bits of the rest."""
    out = [(i * longest, longest) for i in range(n // longest)]
    start, rest = n // longest * longest, n % longest
    while rest:
        length = 1 << (rest.bit_length() - 1)
        out.append((start, length))
        start, rest = start + length, rest - length
    return out


def pieces(
    docs: DataFrame, tokenizer_path: str, max_length: int = MAX_LENGTH, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """Pieces of every document: doc_id, start, length, doc_tokens, ids_crc32 and, if wanted, ids.

    Null texts are empty; every document ends with ``end_id``, so an empty one is one piece of length 1.
    ``max_length`` must be a power of two. Extra columns are ignored.
    """
    if max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = keep(("units", tokenizer_path), lambda: UnitCache(tokenizer_path))
        for whole in batches:
            for low, high in portions(whole.column("text"), BYTES_AT_ONCE):
                batch = whole.slice(low, high - low)
                columns: tuple[list, ...] = ([], [], [], [], [], [])
                encoded = cache.encode([t or "" for t in batch.column("text").to_pylist()])
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                    ids += end
                    for start, length in cuts(len(ids) // 4, max_length):
                        own = ids[4 * start:4 * (start + length)]
                        row = doc_id, start, length, len(ids) // 4, zlib.crc32(own), np.frombuffer(own, "<i4") if with_ids else None
                        for column, value in zip(columns, row):
                            column.append(value)
                arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
                names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32"]
                if with_ids:
                    arrays, names = [*arrays, pa.array(columns[5], pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names)
                give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long"
    return rows.mapInArrow(cut, schema + ", ids array<int>" * with_ids)


def pack(docs: DataFrame, tokenizer_path: str, seed: int = SEED, **options: object) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset`` (always 0). Shorter sequences have smaller numbers.

    Numbers are gapless and depend on the rows alone; repeated documents get sequences of their own.
    """
    made = pieces(docs, tokenizer_path, **options)
    mixed = F.xxhash64(F.lit(seed), "doc_id", "start", "ids_crc32")
    staged = write_stage(made.withColumn("__hash", mixed), "pieces")
    counted = {r["length"]: r["n"] for r in staged.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    bits = bucket_bits(max(counted.values(), default=0))
    placed = with_positions(
        staged.withColumn("__bucket", hash_bucket(F.col("__hash"), bits)), ["length"], "__bucket",
        ["__hash", "doc_id", "start", "ids_crc32"])
    base, bases = 0, F.lit(0)
    for length in sorted(counted):
        bases = F.when(F.col("length") == length, F.lit(base)).otherwise(bases)
        base += counted[length]
    return placed.select(
        *made.columns, (F.col("position") + bases).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
