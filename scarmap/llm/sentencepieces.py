"""Byte-pair encoding and decoding by a table of last tokens, for models of the sentencepiece library.

Merging adjacent symbols, best score first and leftmost among equals, never depends on what lies beyond a boundary that no
merge crosses. So a sequence of pieces is the encoding of its text exactly if each two neighbours encode to themselves
when they stand alone, a prefix of an encoding is the encoding of its own text, and the last piece of every prefix is unique.

An automaton of all pieces gives the pieces that end at each place. The one that is compatible with the last piece of the
prefix before it is the last piece of this prefix and goes into a table; the ids are read from the table backwards. This
takes time in proportion to the text, however long its words are. Compatibility of a pair is found once, from the merges
that make either piece.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from scarmap.llm import textkit as K
from scarmap.llm.registry import query
from scarmap.llm.shared import fresh, table

#: how the library writes a blank
BLANK = "▁"
#: encodings and pair tests that a task remembers, and the longest remembered part of a text
REMEMBERED, PART = 1 << 18, 48
#: letters behind which a text may be cut
LATIN = "A-Za-zÀ-ɏ"
#: what stands before the first piece, and for a character that is no piece: nothing merges with either
OUTSIDE = -1


class Pieces:
    """The vocabulary of a model file, and encodings with it."""

    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, made, kind = model.normalizer_spec, model.trainer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        plain = norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
        if made.model_type != made.BPE or not made.byte_fallback or made.treat_whitespace_as_suffix or not plain:
            raise ValueError("expected a byte-pair model with byte fallback that leaves texts as they are but for a blank in front")
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
            raise ValueError("pieces that are user-defined or unused are not supported")
        self.text = [p.piece for p in model.pieces]
        self.length = [len(p.piece) for p in model.pieces]
        self.score = [p.score for p in model.pieces]
        self.number = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.byte = [0] * 256
        for i, p in enumerate(model.pieces):
            if p.type == kind.BYTE:
                self.byte[int(p.piece[3:5], 16)] = i
        letters = set().union(*self.number)
        if not letters <= set(self.number):
            raise ValueError("every character of a piece must be a piece")
        self.found = ahocorasick.Automaton()
        for piece, i in self.number.items():
            self.found.add_word(piece, (i, len(piece)))
        self.found.make_automaton()
        self.parts = self._cuts(letters)
        self.made: dict[int, list | None] = {}
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _cuts(self, letters: set[str]) -> re.Pattern:
        """Cuts a text where no piece lies across: in front of blanks, behind letters, beside line feeds, as far as that is so."""
        crossed = lambda a, b: any(re.search(f"{a}{b}", p) for p in self.number)
        blank, latin, line = f" {BLANK}", LATIN, "\n"
        if crossed(f"[^{BLANK}]", BLANK):
            return re.compile(r"[\s\S]+")
        if line in letters:
            line = ""
        if crossed(f"[{latin}]", f"[^{latin}]"):
            latin = ""
        word = f"[ {BLANK}]*+[^{blank}{latin}{line}]*+" + (f"[{latin}]*+" if latin else "")
        return re.compile(r"(?!\Z)" + word if not line else rf"{line}|(?!{line}|\Z){word}")

    def history(self, i: int) -> list[tuple[float, str, str]] | None:
        """How merging the best pair, leftmost among equals, makes piece ``i``: per merge its score, then the first and the
        last symbol; before any merge, those of its characters. None if its text is not encoded as this piece."""
        if i not in self.made:
            symbols = list(self.text[i])
            made = [(math.inf, symbols[0], symbols[-1])]
            while len(symbols) > 1:
                pairs = [(self.score[n], -at) for at, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if (n := self.number.get(a + b)) is not None]
                if not pairs:
                    break
                best, at = max(pairs)
                symbols[-at : -at + 2] = [symbols[-at] + symbols[-at + 1]]
                made.append((best, symbols[0], symbols[-1]))
            self.made[i] = made if len(symbols) == 1 else None
        return self.made[i]

    def _test(self, a: int, b: int) -> bool:
        """Whether ``b`` follows ``a``, which encodes to itself: replays the merges of both and looks for one across."""
        found = self.history(b) is not None and (a == OUTSIDE or not self._merge_across(self.history(a), self.history(b)))
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        self.pairs[a * len(self.text) + b] = found
        return found

    def _merge_across(self, left: list, right: list) -> bool:
        x = y = 0
        while True:
            next_left = left[x + 1][0] if x + 1 < len(left) else -math.inf
            next_right = right[y + 1][0] if y + 1 < len(right) else -math.inf
            across = self.number.get(left[x][2] + right[y][1])
            if across is not None and next_left < self.score[across] >= next_right:
                return True
            if x + 1 == len(left) and y + 1 == len(right):
                return False
            if next_left >= next_right:
                x += 1
            else:
                y += 1

    def encode_part(self, text: str) -> list[int]:
        """Ids of ``text``, in which blanks are written as the library does, by the table of last pieces."""
        last = [OUTSIDE] * (len(text) + 1)  # by prefix; a character that is no piece leaves it as it is
        pairs, pieces = self.pairs, len(self.text)
        for end, (piece, length) in self.found.iter(text):
            end += 1
            if last[end] == OUTSIDE:
                before = last[end - length]
                fits = pairs.get(before * pieces + piece)
                if self._test(before, piece) if fits is None else fits:
                    last[end] = piece
        ids, at, lengths = [], len(text), self.length
        while at:
            piece = last[at]
            if piece == OUTSIDE:
                ids += [self.byte[b] for b in reversed(text[at - 1].encode())]
                at -= 1
            else:
                ids.append(piece)
                at -= lengths[piece]
        ids.reverse()
        return ids

    def packed(self, text: str) -> bytes:
        """Ids of a whole text, without any special ids, in four bytes each."""
        if not text:
            return b""
        return b"".join([self.known.get(part) or self._part(part) for part in self.parts.findall(" " + text)])

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without any special ids."""
        return np.frombuffer(self.packed(text), dtype=np.int32).tolist()

    def _part(self, part: str) -> bytes:
        """Ids of a part that is not among the latest. What has been asked for since the memory was full last is kept."""
        ids = self.older.get(part) or np.array(self.encode_part(part.replace(" ", BLANK)), dtype=np.int32).tobytes()
        if len(part) <= PART:
            if len(self.known) >= REMEMBERED // 2:
                self.older, self.known = self.known, {}
            self.known[part] = ids
        return ids


@cache
def _pieces(path: str) -> Pieces:
    return Pieces(path)


@cache
def _processor(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode(docs: DataFrame, model: str, ids: str = "ids", end: bool = True, text: str = "text") -> DataFrame:
    """``docs`` with a column ``ids``: every row's text as ids of the model, with the model's end id behind if ``end``.

    ``model`` is a path that every executor can read. A null text is an empty one, which has no ids but the end id. Every
    row is encoded on its own, so repeated rows and null doc_ids do no harm; an empty table gives no rows. All other
    columns stay; ``ids`` must not be one of them (ValueError; ``shared.fresh`` gives a free name).
    """
    if fresh(docs, ids) != ids:
        raise ValueError(f"there is a column {ids} already")
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        last = np.array([_processor(model).eos_id()] if end else [], dtype=np.int32).tobytes()
        for batch in batches:
            for lo, hi, _, _ in K.text_blocks(batch.column(at)):
                part = batch.slice(lo, hi - lo)
                found = [pieces.packed(x or "") + last for x in part.column(at).to_pylist()]
                ends = pa.array(np.cumsum([0, *map(len, found)]) // 4, pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(found), dtype=np.int32)))
                yield pa.record_batch([*part.columns, lists], schema.names)

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with a column ``name``: the text that the library gives for each row's ids (none of them null); null for a null row."""
    if fresh(rows, name) != name:
        raise ValueError(f"there is a column {name} already")
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())])
    at = rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _processor(model)
        for batch in _blocks(batches, 256):
            lists = batch.column(at)
            flat, cuts = lists.flatten().to_numpy(zero_copy_only=False).tolist(), np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0))]).tolist()
            found = [decoder.decode(flat[a:b]) if there else None for a, b, there in zip(cuts, cuts[1:], lists.is_valid().to_pylist(), strict=False)]
            yield pa.record_batch([*batch.columns, pa.array(found, pa.string())], schema.names)

    return rows.mapInArrow(run, schema)


@query("op12_sentencepieces")
def op12(spark, sf_dir):
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    done = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model).drop("text"), model)
    said = F.array_join(F.col("ids").cast("array<string>"), " ")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(said, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
