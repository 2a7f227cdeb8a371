"""Packing of tokenised documents into sequences of fixed length.

Each document becomes token ids plus one end id and is cut into pieces of at
most one sequence.  Pieces are dealt at random, by a hash, to groups of about
``GROUP_PIECES``; every group is packed on its own by first-fit decreasing: the
longest piece first, each into the first sequence with room.  A tournament
tree over the room left (a node holds the larger of its two children) finds
that sequence in logarithmic time.  Only lengths are shuffled, never ids.

Defined cases: a null text counts as empty, and an empty document is its end
id alone; an empty table gives no pieces; repeated rows are packed each; a
document longer than a sequence gives full pieces and a rest; among pieces of
equal length the order is that of checksum, id and start.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import Scratch

LENGTH = 2048
END_ID = 1
GROUP_PIECES = 4096
KNOWN_WORDS = 500_000  # words whose ids a task remembers
WORD_CHARS = "!-~¡-¬®-ɏ"


class Encoder:
    """Ids of whole texts under a tokenizer file, as little-endian 32-bit numbers.

    If the file describes byte-level BPE with an end-of-word mark over pieces
    that never span a blank, a text is the chain of its words, and the words
    are remembered.  New words of Latin script go through the same merges in a
    second library, all at once; every other word, and every other kind of
    file, goes through ``tokenizers``.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        split = steps[0].get("pattern", {}).get("Regex", "")
        mark = spec["model"].get("end_of_word_suffix") or ""
        plain = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        self.by_word = bool(mark) and plain and "[^\\s" in split and steps[0].get("invert") is True and steps[-1].get("type") == "ByteLevel" and not steps[-1].get("add_prefix_space")
        if self.by_word:
            self.known: dict[str, bytes] = {}
            self.pieces = regex.compile(split)
            self.simple = regex.compile(f"[{WORD_CHARS}]*")
            self.merges, self.ends = self._merges(mark)

    def _merges(self, mark: str):
        """The vocabulary as ranks, with the byte 1 for the end of a word: ids follow the order of the merges."""
        import tiktoken

        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {}
        for token, i in self.tokenizer.get_vocab().items():
            end = token.endswith(mark) and token != mark
            word = token[: -len(mark)] if end else token
            if all(c in byte_of for c in word) and not token.startswith("<|"):
                ranks[bytes(byte_of[c] for c in word) + b"\x01" * end] = i
        ends = np.zeros(max(ranks.values()) + 1, bool)
        ends[[i for b, i in ranks.items() if b.endswith(b"\x01") and len(b) > 1]] = True
        return tiktoken.Encoding("words", pat_str="[^\x01]+\x01", mergeable_ranks=ranks, special_tokens={}), ends

    def _learn(self, words: set[str]) -> None:
        names, numbers, parts = [], [], []
        for w in words:
            if w.isascii() and w.isalpha():
                found = [w.lower()]
            elif self.simple.fullmatch(w) and "<|" not in w:
                found = self.pieces.findall(unicodedata.normalize("NFC", w).lower())
            else:
                self.known[w] = np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
                continue
            names.append(w)
            numbers.append(len(found))
            parts += found
        if names:
            ids = np.array(self.merges.encode_ordinary("\x01".join(parts) + "\x01" if parts else ""), "<u4")
            stops = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])[np.concatenate([[0], np.cumsum(numbers)])] * 4
            raw = ids.tobytes()
            self.known.update((w, raw[a:b]) for w, a, b in zip(names, stops[:-1].tolist(), stops[1:].tolist()))

    def encode(self, text: str) -> bytes:
        if not self.by_word:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = text.replace("\n", " ").split(" ")
        new = {w for w in words if w not in self.known}
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
            new = set(words)
        if new:
            self._learn(new)
        return b"".join(map(self.known.__getitem__, words))


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens and, if wanted, the ids as little-endian 32-bit numbers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows, starts, sizes, sums, totals, ids = [], [], [], [], [], []
            for i, t in enumerate(batch.column(1)):
                raw = encoder.encode(t.as_py() or "") + end
                for at in range(0, len(raw), 4 * length):
                    part = raw[at : at + 4 * length]
                    rows.append(i)
                    starts.append(at // 4)
                    sizes.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    totals.append(len(raw) // 4)
                    if with_ids:
                        ids.append(part)
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, sizes, sums, totals))]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    rows = docs.select(F.col(key).alias(key), F.col(text).alias("_text"))
    out = T.StructType([T.StructField(key, rows.schema[key].dataType), *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens"))])
    if with_ids:
        out = out.add("ids", T.BinaryType())
    return rows.mapInArrow(cut, out)


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each size; ``sizes`` fall, none exceeds ``capacity``."""
    width = 1 << max(0, len(sizes) - 1).bit_length()
    room = [capacity] * (2 * width)  # tournament tree: room[1] is the largest room of all bins
    bins, offsets = [], []
    for size in sizes:
        node = 1
        while node < width:
            node *= 2
            if room[node] < size:
                node += 1
        bins.append(node - width)
        offsets.append(capacity - room[node])
        room[node] -= size
        while node > 1:
            node //= 2
            larger = room[2 * node] if room[2 * node] >= room[2 * node + 1] else room[2 * node + 1]
            if room[node] == larger:
                break
            room[node] = larger
    return bins, offsets


def pack(parts: DataFrame, length: int = LENGTH, key: str = "doc_id", group_pieces: int = GROUP_PIECES, seed: int = 1) -> DataFrame:
    """``parts`` (as from :func:`pieces`) with ``sequence_id`` and ``offset``; the upper half of a sequence id is its group."""
    rows = Scratch(parts.sparkSession).keep(parts)
    groups = max(1, -(-rows.count() // group_pieces))

    def fill(group: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("ids_crc32", "ascending"), (key, "ascending"), ("start", "ascending")]
        group = group.sort_by(order)
        bins, offsets = first_fit_decreasing(group.column("length").to_pylist(), length)
        number = np.array(bins, np.int64) + (group.column("_group")[0].as_py() << 32)
        return group.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offsets, pa.int64())).drop_columns(["_group"])

    dealt = F.pmod(F.xxhash64(F.lit(seed), F.col(key), "start", "ids_crc32"), F.lit(groups))
    out = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return rows.withColumn("_group", dealt).groupBy("_group").applyInArrow(fill, out)
