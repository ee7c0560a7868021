"""Packing documents into token sequences by best-fit decreasing.

A document becomes its token ids and one end id. What is longer than a sequence is cut into full
sequences first; the rest (one piece a document, shorter than a sequence) is packed best-fit
decreasing: longest piece first, each into the open sequence with the least room that still holds
it. Rooms are whole numbers up to the sequence size, so a segment tree over the remaining room
finds the tightest one in log2(size) steps, however many are open.

At scale: tokenizing is a map over the documents; only (doc_id, start, length, checksum) rows move
(the ids only if asked for).
Pieces are dealt by hash to packers of about ``PACKER_ROWS`` documents, and each packs on its own:
thousands of pieces leave hardly more room than one packer for all would, which would be one task.
The second and later pieces of equal rows are dealt by their number and task as well, so a hot row is
spread over all packers; as they are equal, a task run again deals the same pieces whatever the order.

The tokenizer splits at white space, so the ids of a text are those of its words: a worker keeps
the ids of words it has met (up to ``WORD_CACHE`` words) and works out new words only; past that, and
after a task, it keeps the first ``WORDS_KEPT`` and gives the others' memory back. Words of Latin
letters, digits and signs are cut into the tokenizer's runs here, and only the tokenizer's model
works on them; other words, and texts that hold a special token's string, go through the tokenizer whole.

Defined cases: null text is empty; an empty text is the end id alone (one piece of length 1). A
null doc_id is packed like any other. Rows that repeat a doc_id are packed each on its own. Empty
table: empty result. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from itertools import compress, islice
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import mix, slices

SIZE = 2048
END_ID = 1
PACKER_ROWS = 4096
WORD_CACHE = 1 << 20
WORDS_KEPT = 1 << 17
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, packer long"

_LOADED: dict[str, "WordTokens"] = {}

# A tokenizer of this kind cuts words into runs of letters, single numbers and runs of what is neither; each run
# goes to its model alone, as the characters that stand for its bytes. Here the runs are found without it where
# characters have one class in every Unicode version and lower-case to one of their kind: Latin up to U+017F,
# without apostrophes (contractions), white space and what some count as such.
_KNOWN_SPLIT = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})
_LATIN = [c for c in map(chr, range(0x180)) if c not in "'\u0130" and not c.isspace()]
_LETTER, _NUMBER = (re.escape("".join(c for c in _LATIN if unicodedata.category(c)[0] == kind)) for kind in "LN")
_PLAIN = re.compile(f"[{re.escape(''.join(_LATIN))}]+")
_RUNS = re.compile(f"[{_LETTER}]+|[{_NUMBER}]|[^{_LETTER}{_NUMBER}]+")
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
_BYTES = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b != ord("'"))
#: Letters with a composed small form only: lower-cased ahead of the tokenizer they would be composed.
_LATE = re.compile(rb"[A-Z]\xcc")


class WordTokens:
    """Ids of a text as little-endian unsigned 32-bit bytes, word by word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}
        self.first: dict[bytes, bytes] = {}
        spec = json.loads(self.tokenizer.to_str())
        self.runs = None  # the model alone, if runs can be cut here
        if (spec["normalizer"], spec["pre_tokenizer"]) == _KNOWN_SPLIT and spec["model"].get("end_of_word_suffix"):
            self.runs = Tokenizer(self.tokenizer.model)
            self.runs.pre_tokenizer = WhitespaceSplit()
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(spec["model"]["end_of_word_suffix"])]] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _run_ids(self, runs: list[bytes], shown: list[str]) -> None:
        """Learn runs, many in one call; a run's last token is one that ends words."""
        for at in range(0, len(runs), 256):
            some = runs[at:at + 256]
            ids = np.array(self.runs.encode_batch_fast([" ".join(shown[at:at + 256])], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):
                ids, ends = ids.tobytes(), (4 * ends).tolist()
                self.known.update(zip(some, [ids[a:b] for a, b in zip([0, *ends], ends)]))
            else:
                self.known.update(zip(some, self._ids([x.decode() for x in some])))

    def _learn(self, words: set[bytes]) -> None:
        known, letters, cut, rest = self.known, [], [], []
        for w in words if self.runs else ():
            core = w.rstrip(_SIGNS)
            if core.isalpha():  # letters of ASCII, in lower case
                if len(core) == len(w):
                    letters.append(w)
                else:
                    cut.append((w, core, w[len(core):]))
            elif _PLAIN.fullmatch(text := w.decode()):
                cut.append((w, *map(str.encode, _RUNS.findall(text.lower()))))
            else:
                rest.append(w)
        self._run_ids(letters, [x.decode() for x in letters])
        need = list({x for _, *runs in cut for x in runs if x not in known})
        self._run_ids(need, [x.decode() if x.isalnum() else "".join([_BYTES[b] for b in x]) for x in need])
        for w, *runs in cut:
            known[w] = b"".join([known[x] for x in runs])
        rest = rest if self.runs else list(words)
        if rest:
            known.update(zip(rest, self._ids([w.decode() for w in rest])))

    def forget(self) -> None:
        """Start anew with the words learnt first, the most frequent ones among them; the rest is given back."""
        if len(self.first) < WORDS_KEPT:  # copies, so that no block of memory is held for a few of its words
            self.first = {bytes(bytearray(w)): bytes(bytearray(ids)) for w, ids in islice(self.known.items(), WORDS_KEPT)}
        self.known = self.first.copy()

    def encode(self, texts: list[str]) -> list[bytes]:
        rows, found, new = [], [], set()
        find = self.known.get
        for text in texts:
            data = text.encode()
            if any(s in data for s in self.special) or b"\xcc" in data and _LATE.search(data):
                rows.append((None, None))
                found.append(None)
                continue
            words = data.lower().split()
            ids = list(map(find, words))  # one look-up a word that is known
            gaps = list(compress(range(len(ids)), map(not_, ids)))
            new.update([words[i] for i in gaps])
            rows.append((words, gaps))
            found.append(ids)
        if len(self.known) + len(new) > WORD_CACHE:
            self.forget()
        if new:
            self._learn(new)
        out = []
        for text, (words, gaps), ids in zip(texts, rows, found):
            if words is None:
                out.append(self._ids([text])[0])
                continue
            for i in gaps:
                ids[i] = self.known[words[i]]
            out.append(b"".join(ids))
        return out


def _tokenizer(path: str) -> WordTokens:
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path)
    return _LOADED[path]


def _pieces(path: str, size: int, end_id: int, packers: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        tokens = _tokenizer(path)
        place = np.uint64(TaskContext.get().partitionId() + 1) << np.uint64(40)
        copies: dict[int, int] = {}  # pieces met so far, by key: a piece met again goes to a packer of its own
        for batch in slices(batches, "text", 1 << 20):
            out = []
            for doc, ids in zip(batch.column(0).to_pylist(), tokens.encode(["" if x is None else x for x in batch.column(1).to_pylist()])):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, size):
                    piece = ids[4 * start:4 * (start + size)]
                    out.append((doc, start, len(piece) // 4, zlib.crc32(piece), n, piece if with_ids else None))
            doc, start, length, crc, n, held = zip(*out)
            key = mix(np.array([x or 0 for x in doc], np.int64).view(np.uint64) * np.uint64(31) + np.array(start, np.uint64) + (np.array(crc, np.uint64) << np.uint64(24)))
            again = np.zeros(len(key), np.uint64)
            for i, k in enumerate(key.tolist()):
                again[i] = copies.get(k, 0)
                copies[k] = int(again[i]) + 1
            key = np.where(again > 0, mix(key + again * np.uint64(0x9E3779B97F4A7C15) + place), key)
            cols = [pa.array(doc, pa.int64()), *(pa.array(x, pa.int64()) for x in (start, length, crc, n)), pa.array((key % np.uint64(packers)).astype(np.int64))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "packer"]
            if with_ids:
                cols, names = [*cols, pa.array(held, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)
        tokens.forget()  # the worker stays for other tasks
    return run


class Rooms:
    """Segment tree over remaining room: the open sequence with the least room of at least ``need``."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.open = [0] * (2 * self.width)  # sequences below each node
        self.at = [[] for _ in range(size + 1)]  # those with exactly this room

    def add(self, room: int, sequence: int) -> None:
        self.at[room].append(sequence)
        node = self.width + room
        while node:
            self.open[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, sequence) of the tightest fit, taken out; None if none fits."""
        tree, node = self.open, self.width + need
        while not tree[node]:  # up, until a right sibling has an open sequence
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
            if node & (node - 1) == 0:
                return None
        while node < self.width:
            node = 2 * node if tree[2 * node] else 2 * node + 1
        room = node - self.width
        while node:
            tree[node] -= 1
            node >>= 1
        return room, self.at[room].pop()


def best_fit_decreasing(lengths: list[int], size: int) -> tuple[list[int], list[int], int]:
    """(sequence, offset) of each piece, and how many sequences; ``lengths`` in falling order."""
    rooms, sequence, offset, used = Rooms(size), [], [], 0
    for n in lengths:
        fit = rooms.take(n) if n < size else None
        room, s = fit if fit else (size, used)
        if not fit:
            used += 1
        sequence.append(s)
        offset.append(size - room)
        if room > n:
            rooms.add(room - n, s)
    return sequence, offset, used


def _pack(size: int):
    def close(packer, rows):
        # Longest first; ties by document, so that a task run again packs the same.
        lengths = rows.column("length").to_numpy()
        order = np.lexsort((rows.column("ids_crc32").to_numpy(), rows.column("start").to_numpy(), rows.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy(), -lengths))
        rows = rows.take(pa.array(order))
        sequence, offset, _ = best_fit_decreasing(lengths[order].tolist(), size)
        rows = rows.drop_columns(["packer"]).append_column("sequence_id", pa.array([(packer << 32) + s for s in sequence], pa.int64())).append_column("offset", pa.array(offset, pa.int64()))
        return rows.combine_chunks().to_batches()

    def run(batches):
        current, held = None, []
        for batch in batches:
            packers = batch.column(batch.schema.get_field_index("packer")).to_numpy()
            cuts = np.append(np.flatnonzero(np.append(True, packers[1:] != packers[:-1])), len(packers)) if len(packers) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held and packers[a] != current:
                    yield from close(current, pa.Table.from_batches(held))
                    held = []
                current = int(packers[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from close(current, pa.Table.from_batches(held))
    return run


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """documents (doc_id, text) -> one row a piece: doc_id, start (ids of its document before it),
    length, ids_crc32, doc_tokens, sequence_id, offset; ``with_ids`` adds the ids themselves.

    ``tokenizer`` is the path of a tokenizer file that every executor can read."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    packers = max(1, -(-docs.count() // PACKER_ROWS))
    more = ", ids binary" if with_ids else ""
    pieces = docs.mapInArrow(_pieces(tokenizer, size, end_id, packers, with_ids), PIECE + more)
    pieces = pieces.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "packer").sortWithinPartitions("packer")
    return pieces.mapInArrow(_pack(size), PIECE.removesuffix(", packer long") + more + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """Pieces with ids -> (sequence_id, length, ids array<int>): a group is at most one sequence long."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit("").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    one = packed.groupBy("sequence_id").agg(F.sum("length").cast("long").alias("length"), F.hex(joined).alias("h"))
    ids = F.transform(F.sequence(F.lit(0), F.col("length") - 1),
                      lambda i: F.conv(F.concat(*(F.substring("h", (8 * i + k).cast("int"), F.lit(2)) for k in (7, 5, 3, 1))), 16, 10).cast("int"))
    return one.select("sequence_id", "length", ids.alias("ids"))
