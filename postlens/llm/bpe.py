"""Byte-level BPE encoding and decoding.

A text is cut by the special tokens of the vocabulary, then into words by its pattern. A word starts as an array of
single bytes beside an array of the merge ranks of neighbours; the smallest rank (leftmost first) is looked for, its
boundary deleted and the two ranks beside it refreshed until no merge is left. Both arrays are short and contiguous, so
scanning them beats a heap. Words repeat, hence each task keeps a bounded table of words already cut. A word longer than
``LONG`` bytes (a run of letters without any break) is cut with a heap of ranks instead, which gives the same parts in
``n log n`` time.

Decoding takes the pieces of a whole batch by id and joins them by text, in columns; only a batch with bytes that are no
UTF-8 is decoded text by text.

Null texts count as empty (no ids, decoded ``""``), texts of any length are encoded whole, null ids decode to ``""``.
Rows map one to one, repeated rows and empty tables included; other columns stay, but for one that has the name of the result,
which is replaced. The vocabulary (about 1 MB, fixed) is read on the driver and broadcast.
"""
import json
import re
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import shipped

shipped(__name__)


# Fixed value: the word pattern of the vocabulary's pre-tokeniser, and the same for ASCII texts.
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"""
           r"""|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+""")
PLAIN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"""
LONG = 256
WORDS_KEPT, ROWS = 250_000, 256
NEVER = 1 << 29


def byte_letters():
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def load(path):
    """``(ids by bytes, merge ranks by pair of ids, special tokens)`` of a vocabulary file."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    letters, model = byte_letters(), content["model"]
    ids = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = (bytes(letters[c] for c in part) for part in (pair.split(" ") if isinstance(pair, str) else pair))
        merges[ids[left], ids[right]] = (rank, ids[left + right])
    return ids, merges, {t["content"]: t["id"] for t in content["added_tokens"]}


class Words(dict):
    """Ids of words as bytes of 32-bit numbers, cut when first asked for."""

    def __init__(self, ids, merges):
        self.single, self.others = [ids[bytes([b])] for b in range(256)], 0
        # Rank of a pair by its left, then its right part, and the id a rank makes.
        none = {}
        self.ranks = [none] * (max(ids.values()) + 1)
        self.made = [0] * (max((rank for rank, _ in merges.values()), default=0) + 1)
        for (left, right), (rank, joined) in merges.items():
            if self.ranks[left] is none:
                self.ranks[left] = {}
            self.ranks[left][right], self.made[rank] = rank, joined

    def __missing__(self, word):
        parts = [self.single[b] for b in word.encode()]
        if len(parts) > LONG:
            return array("i", self.by_heap(parts)).tobytes()
        found = array("i", self.by_scan(parts)).tobytes()
        if len(self) < WORDS_KEPT:
            self[word] = found
        else:
            # The first words are the frequent ones and stay, until so many others come that the texts must have changed.
            self.others += 1
            if self.others > 8 * WORDS_KEPT:
                self.clear()
                self.others = 0
        return found

    def by_scan(self, parts):
        ranks, made = self.ranks, self.made
        near = [ranks[a].get(b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while near:
            best = min(near)
            if best == NEVER:
                break
            i, joined = near.index(best), made[best]
            parts[i] = joined
            del parts[i + 1], near[i]
            if i:
                near[i - 1] = ranks[parts[i - 1]].get(joined, NEVER)
            if i < len(near):
                near[i] = ranks[joined].get(parts[i + 1], NEVER)
        return parts

    def by_heap(self, parts):
        ranks, made, n = self.ranks, self.made, len(parts)
        after, before, heap = [*range(1, n), -1], [*range(-1, n - 1)], []

        def offer(i):
            if i >= 0 and after[i] >= 0 and (rank := ranks[parts[i]].get(parts[after[i]], NEVER)) != NEVER:
                heappush(heap, (rank, i, parts[i], parts[after[i]]))

        for i in range(n - 1):
            if (rank := ranks[parts[i]].get(parts[i + 1], NEVER)) != NEVER:
                heap.append((rank, i, parts[i], parts[i + 1]))
        heapify(heap)
        while heap:
            rank, i, left, right = heappop(heap)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue
            parts[i], parts[j], after[i] = made[rank], None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]


def encoder(ids, merges, special):
    """A function from text to ids, as bytes of 32-bit numbers."""
    words, cut_any, cut_plain = Words(ids, merges), regex.compile(PATTERN).findall, re.compile(PLAIN_PATTERN, re.ASCII).findall
    get, special_ids = words.__getitem__, {t: array("i", [i]).tobytes() for t, i in special.items()}
    marks = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def cut(text):
        return b"".join(map(get, cut_plain(text) if text.isascii() else cut_any(text)))

    def encode(text):
        if marks and any(s in text for s in special):
            return b"".join(special_ids[p] if k % 2 else cut(p) for k, p in enumerate(marks.split(text)))
        return cut(text)
    return encode


def _encoding(content):
    """A function from a column of texts to a column of ids."""
    one = encoder(*content)

    def run(texts):
        found = [one(t or "") for t in texts.to_pylist()]
        return _lists(np.array([len(f) // 4 for f in found], np.int64), pa.array(np.frombuffer(b"".join(found), np.int32)))
    return run


def _decoding(content):
    """A function from a column of ids to a column of texts."""
    known, _, special = content
    pieces = [None] * (1 + max([*known.values(), *special.values()]))
    for piece, i in [*known.items(), *((t.encode(), i) for t, i in special.items())]:
        pieces[i] = piece
    pieces = pa.array(pieces, pa.binary())

    def run(ids):
        parts = pieces.take(ids.flatten())
        if parts.null_count:
            raise ValueError("ids that are not in the vocabulary")
        joined = pc.binary_join(_lists(pc.list_value_length(ids).fill_null(0).to_numpy(zero_copy_only=False), parts), b"")
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([b.decode("utf-8", "replace") for b in joined.to_pylist()], pa.string())
    return run


def _lists(lengths, values):
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def _mapped(docs, vocabulary, first, steps):
    """``docs`` with one more column per step (name, type, maker), each made from the one before, the first from ``first``."""
    content = docs.sparkSession.sparkContext.broadcast(load(vocabulary))
    docs = docs.drop(*[name for name, _, _ in steps if name != first])
    schema = T.StructType([*docs.schema.fields, *[T.StructField(name, kind) for name, kind, _ in steps]])

    def batches(source):
        makers = None
        for whole in source:
            makers = makers or [make(content.value) for _, _, make in steps]
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                last, made = batch.column(batch.schema.get_field_index(first)), []
                for make in makers:
                    last = make(last)
                    made.append(last)
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], schema.names)
    return docs.mapInArrow(batches, schema)


IDS = T.ArrayType(T.IntegerType(), False)


def encode(docs, vocabulary, text="text", ids="ids", keep_text=True):
    """``docs`` with an array of token ids."""
    out = _mapped(docs, vocabulary, text, [(ids, IDS, _encoding)])
    return out if keep_text else out.drop(text)


def decode(docs, vocabulary, ids="ids", text="decoded"):
    """``docs`` with the text of its token ids; bytes that are no UTF-8 become U+FFFD."""
    return _mapped(docs, vocabulary, ids, [(text, T.StringType(), _decoding)])


def round_trip(docs, vocabulary, text="text", ids="ids", decoded="decoded"):
    """``docs`` encoded and its ids decoded, in one pass over the table."""
    return _mapped(docs, vocabulary, text, [(ids, IDS, _encoding), (decoded, T.StringType(), _decoding)])


def digests(docs, vocabulary):
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text."""
    coded = round_trip(docs.select("doc_id", "text"), vocabulary)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
