"""Encoding and decoding with a sentencepiece model through distinct chunks, and token counts for packing."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Entries that a worker's table holds before it begins anew, which bounds its memory.
TABLE_ENTRIES = 300_000
#: Documents that are looked up together.
SLICE = 256
_RUNS = re.compile(" +[^ ]*")
_MARK = "▁"


class ChunkTable:
    """Ids of a whole text by way of its marked words.

    No piece of the model crosses from a word into the marker before the next one, which is checked on the
    vocabulary; so a merge never does, and the ids of a text are those of its chunks, each a run of markers
    and the word behind it. Each distinct chunk is segmented by the library once, and ids are joined by position.
    """

    def __init__(self, model: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.library.id_to_piece(k) for k in range(self.library.get_piece_size())]
        if any(_MARK in x.lstrip(_MARK) for x in pieces):
            raise ValueError("a piece of this model crosses a whitespace marker")
        if "".join(self.library.encode("a  b ", out_type=str)) != f"{_MARK}a{_MARK * 2}b{_MARK}":
            raise ValueError("this model changes white space before it segments")
        self.starts = np.array([x.startswith(_MARK) for x in pieces])
        self.shown = [str(k) for k in range(len(pieces))]
        self.known: dict[str, tuple[str, list[int]]] = {}
        self._forget()

    def _forget(self) -> None:
        # A lone marker can't be asked for as a text, which gets a marker of its own.
        lone = self.library.piece_to_id(_MARK)
        self.known = {"": (str(lone), [lone])}

    def chunks(self, text: str) -> list[str]:
        """Each chunk without its first marker."""
        if not text:
            return []
        text = text.replace(_MARK, " ")
        if "  " in text or text[0] == " ":
            return [x[1:] for x in _RUNS.findall(f" {text}")]
        return text.split(" ")

    def _learn(self, new: list[str]) -> None:
        """Segments chunks: those of one marker in one text, cut where a piece begins with a marker; others one by one."""
        one, odd = [x for x in new if x[:1] != " "], [x for x in new if x[:1] == " "]
        found = self.library.encode(odd, num_threads=1) if odd else []
        if one:
            ids = self.library.encode(" ".join(one), num_threads=1)
            cuts = [*np.flatnonzero(self.starts[ids]).tolist(), len(ids)]
            if len(cuts) != len(one) + 1:
                raise ValueError("chunks and pieces differ")
            found = [ids[x:y] for x, y in zip(cuts, cuts[1:])] + found
        shown = self.shown.__getitem__
        self.known.update((x, (" ".join(map(shown, ids)), ids)) for x, ids in zip(one + odd, found, strict=True))

    def values(self, texts: list[str]) -> Iterator[list[tuple[str, list[int]]]]:
        """For each text the decimal ids, joined by spaces, and the ids of its chunks, in order."""
        for at in range(0, len(texts), SLICE):
            own = list(map(self.chunks, texts[at : at + SLICE]))
            if len(self.known) > TABLE_ENTRIES:
                self._forget()
            if new := list(set(chain.from_iterable(own)).difference(self.known)):
                self._learn(new)
            for x in own:
                yield list(map(self.known.__getitem__, x))


#: A worker keeps its tables from task to task.
@lru_cache(maxsize=1)
def chunk_table(model: str) -> ChunkTable:
    return ChunkTable(model)


def encode_digest(documents: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 for every whole text: encoded with an end id, then decoded.

    A null text is empty and has the end id alone; every row gives a row, repeated ones too, and a null
    doc_id stays null. Other columns are ignored. The chunk table belongs to a worker, as a table of all chunks
    of the corpus could only be joined back through a row for each word of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model)
        end = table.library.eos_id()
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            n, told, back = [], [], []
            for own in table.values(texts):
                ids = list(chain.from_iterable(x[1] for x in own))
                ids.append(end)
                shown = " ".join([x[0] for x in own])
                n.append(len(ids))
                told.append(hashlib.sha256(f"{shown} {end}".encode() if own else b"%d" % end).hexdigest())
                back.append(hashlib.sha256(table.library.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(told), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_ids(documents: DataFrame, model: str) -> DataFrame:
    """doc_id and ids (array of int, with the end id) for every whole text; the cases are those of ``encode_digest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model)
        end = [table.library.eos_id()]
        for batch in batches:
            ids = [[*chain.from_iterable(x[1] for x in own), *end] for own in table.values([x or "" for x in batch.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return documents.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text from doc_id and ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = chunk_table(model).library
        for batch in batches:
            texts = [library.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.selectExpr("cast(doc_id as long) as doc_id", "ids").mapInArrow(run, "doc_id long, text string")


END = 1
#: Python's str.split() also splits at these, which the tokenizer takes for ordinary characters.
_NOT_SPACE = "\x1c\x1d\x1e\x1f"
#: Stands between words that are looked up together; words that hold it are looked up alone.
_BETWEEN = "\u2605"
#: How the tokenizer cuts lower-case text into units, for characters up to U+024F, where its classes of letters
#: and numbers are those below; and what begins its special tokens.
_LETTERS, _NUMBERS, _SPACES = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", " \t-\r\x85\xa0"
_UNITS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
_BEYOND = re.compile("[^\\x00-\u024f]")
_SPECIAL = "<|"


class WordTable:
    """Little-endian 32-bit ids of a whole text, for a tokenizers file that cuts text into units which no piece crosses.

    A text of characters up to U+024F is cut into units as the tokenizer does, lower-cased, and each distinct unit is segmented
    once: those of letters many in one text, of which the pieces that end a word tell the units apart. Other texts are cut at
    white space, and each distinct word is segmented once.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(model)
        self.between = self.ids(_BETWEEN)
        if len(self.between) != 1 or self.ids("x y  z").tolist() != [k for x in "xyz" for k in self.ids(x)]:
            raise ValueError("pieces of this tokenizer cross white space")
        pieces = self.library.get_vocab()
        self.ends = np.zeros(max(pieces.values()) + 1, bool)
        self.ends[[k for x, k in pieces.items() if x.endswith("</w>")]] = True
        self.units: dict[str, bytes]
        self.words: dict[str, bytes]
        self.forget()
        probe = "It's a1 D\xdcNE\xdf.\xa0x!'s don't ?!\xbd\x1cb\u01c5 we'll 12"
        if list(self.encode([probe]))[0] != self.ids(probe).tobytes():
            raise ValueError("this tokenizer cuts text in another way")

    def forget(self) -> None:
        self.units, self.words = {}, {}

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _parted(self, words: list[str], ids: np.ndarray, cuts: np.ndarray, skip: int) -> dict[str, bytes]:
        """Each word's ids, between ``cuts``, of which each but the first is preceded by ``skip`` ids that aren't a word's."""
        if len(cuts) != len(words) + 1:
            raise ValueError("words and ids differ")
        raw, cuts = ids.tobytes(), (4 * cuts).tolist()
        return {w: raw[x : y - 4 * skip] for w, x, y in zip(words, cuts, cuts[1:])}

    def _alone(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words, segmented in one text with a sign between them."""
        one, odd = [x for x in words if _BETWEEN not in x], [x for x in words if _BETWEEN in x]
        out = {x: self.ids(x).tobytes() for x in odd}
        if one:
            ids = self.ids(f" {_BETWEEN} ".join([*one, ""]))
            out |= self._parted(one, ids, np.append(0, np.flatnonzero(ids == self.between[0]) + 1), 1)
        return out

    def _learn_units(self, new: list[str]) -> None:
        letters = list(filter(str.isalpha, new))
        if letters:
            ids = self.ids(" ".join(letters))
            self.units |= self._parted(letters, ids, np.append(0, np.flatnonzero(self.ends[ids]) + 1), 0)
        self.units |= self._alone([x for x in new if not x.isalpha()])

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), SLICE):
            plain, own = [], []
            for text in texts[at : at + SLICE]:
                low = text.lower()
                plain.append(not _BEYOND.search(low) and _SPECIAL not in low)
                if plain[-1]:
                    own.append(_UNITS.findall(low))
                else:
                    own.append(None if any(x in text for x in _NOT_SPACE) else text.split())
            if len(self.units) > TABLE_ENTRIES:
                self.units = {}
            if len(self.words) > TABLE_ENTRIES:
                self.words = {}
            if new := list(set().union(*(x for x, p in zip(own, plain, strict=True) if p)).difference(self.units)):
                self._learn_units(new)
            if new := list(set().union(*(x for x, p in zip(own, plain, strict=True) if x and not p)).difference(self.words)):
                self.words |= self._alone(new)
            for text, parts, p in zip(texts[at : at + SLICE], own, plain, strict=True):
                table = self.units if p else self.words
                yield self.ids(text).tobytes() if parts is None else b"".join(map(table.__getitem__, parts))


@lru_cache(maxsize=1)
def word_table(model: str) -> WordTable:
    return WordTable(model)


def cut_pieces(documents: DataFrame, model: str, capacity: int) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and task for each piece of at most ``capacity`` ids of every text.

    A document's ids end with END, so that a null or empty text has one piece of one id. Only a document's
    last piece is shorter than ``capacity``. ``task`` numbers the partition that made the piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table, task = word_table(model), TaskContext.get().partitionId()
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            rows = []
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), table.encode(texts), strict=True):
                ids += end
                for at in range(0, len(ids), 4 * capacity):
                    own = ids[at : at + 4 * capacity]
                    rows.append((doc, at // 4, len(own) // 4, zlib.crc32(own), len(ids) // 4, task))
            if rows:
                columns = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task"])
        table.forget()  # idle workers keep their memory, and a task fills a table by itself

    return documents.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task long")
