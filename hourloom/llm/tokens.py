"""Whole texts to token ids with the tokenizers library.

A text is cut before each single space that stands between other characters: no token of these vocabularies reaches over
such a place, so the ids of the pieces, joined, are the ids of the text. Pieces repeat, so that the library encodes each
distinct piece about once a worker. Texts with runs of spaces or special-token marks go to the library as they are, and so
do all texts if the cuts don't give the whole library's ids on the probes when the vocabulary is loaded.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_PLAIN = re.compile("\x00?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
#: Places, besides single spaces, that no token reaches over: before a comma or stop between a letter and white space,
#: and around a line end between other characters.
_STOP = re.compile("[,.][ \n](?<=[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff][,.][ \n])")
_LINE = re.compile(r"\n(?<=\S\n)(?=\S)")
#: A run of white space that would be cut at its inner or last space.
_RUN = re.compile(r"[^\S ] (?!\S)")
_PROBES = ("the", "\x00the", "Thandouer", "\x00ETE", "\xe9t\xe9s", "\x00\xc9l\xe8ve", "Stra\xdfe", "\xd1and\xfa", "a", "\x00\xe7")
#: How byte-level vocabularies spell bytes: printable ones as themselves, the rest in order from U+0100.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _OWN)}
_SPELT = {c: chr(c).encode().decode("latin-1").translate(_BYTES) for c in range(256)}


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file; operators take any path instead."""
    import public_tokenizers

    return public_tokenizers.path(name)


_LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
#: Texts on which cuts must give the library's ids: stops, line ends, marks, digits, letters whose lower case is longer.
_TEXTS = (
    "One two, three. Four\nfive, six.\nSeven", "it's don't 3.5, end. A, b", "a (b) c; d: e! f? g-h i_j", "\u0130, a \u0130. b \u0149, c \u01f0. d", "\xc9lan \xe9t\xe9, \xe7a. \xdf. \xfe,", "\u6f22\u5b57, \u6f22. \u03b1\u03b2, \u0436.", "x,\ny. z ,a .b", "e\u0301, o\u0308. n\u0303\nm", "tab\tand\rcr, nbsp\xa0. q",
)


#: Characters whose runs of one class (letters, digits, marks without the apostrophe) a byte-level vocabulary cuts apart.
_CLASSES = ("A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9", "!-&(-/:-@\\[-`{-~")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_CUT = re.compile(f"\x00?[{''.join(_CLASSES)}]+")
_CLASS_RUN = re.compile("|".join(f"[{c}]+" for c in _CLASSES))
_CUT_PROBES = ("ORS!!", "\x00ORS,!!", "84.251.36.42", "+1", "(716)", "555-8176", "\x00ab.85@mail2.example.com", "4807614710343232", "|", "\x00a|b", "x3y_\xe9[z]", "{\xc9t\xe9}", "\x00!?", "\x00200", "$5%", "``a^~", "\x00]", "#")


#: Bytes of a text by kind: letter or digit a, comma and stop ., other mark !, space, line end; all else is y.
_KINDS = bytes(
    97 if chr(b).isalnum() and b < 128 or b == 0xC3 or 0x80 <= b < 0xC0 and b not in (0x97, 0xB7) else 46 if b in b",." else b if b in b" \n" else 33 if 33 <= b < 127 else 121
    for b in range(256)
)
#: Kinds side by side of texts that are not plain: there a comma, stop or line end may belong to a longer token.
_NOT_PLAIN = (b"y", b"  ", b"..", b"!.", b" .", b"\n.", b"\n\n", b"\n ", b" \n")
#: The same of a whole column, and how such texts begin or end.
_NOT_PLAIN_RE2 = "|".join(x.decode().replace(".", "[.]") for x in _NOT_PLAIN) + r"|\A[.\n]|\n\z"
#: What a plain text is cut by: each is replaced, one after the other, so that pieces stand between single spaces.
_PLAIN_CUTS = ((", ", " \x00, "), (". ", " \x00. "), (",\n", " \x00,\n"), (".\n", " \x00.\n"), ("\n", " \x00\n \x00"))
LONG = 1 << 26  # bytes of a text that is not cut in a column: columns of cut texts hold at most 2^31


def _plain(texts: pa.StringArray) -> np.ndarray:
    """Of each text (none is null) whether `Encoder.plain` cuts it; not so texts of LONG bytes or more."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    kinds = memoryview(data)[offsets[0] : offsets[-1]].tobytes().translate(_KINDS) if data else b""
    kinds = pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(kinds))
    other = pc.or_(pc.match_substring_regex(kinds, _NOT_PLAIN_RE2), pc.match_substring(texts, "<|"))
    return ~other.to_numpy(zero_copy_only=False) & (np.diff(offsets) < LONG)


class _Pieces(dict):
    """Ids of pieces, found when first asked for. `older` are those of before, of which the ones asked for again stay."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.older = encoder, {}

    def __missing__(self, piece: str) -> bytes:
        value = self.older.get(piece)
        if value is None:
            value = self.encoder.piece(piece)
        self[piece] = value
        return value

    def age(self) -> None:
        self.older = self.copy()
        self.clear()


class Encoder:
    def __init__(self, path: str, most: int = 600_000, ages: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces = _Pieces(self)
        self.most, self.ages = most, ages
        #: How a run of letters is spelled for the vocabulary's own merges: (mark of a space, lower case). A spelling is
        #: used only if it gives the whole library's ids on the probes; it spares a library call's fixed costs.
        self.spelling = next((s for s in (("\u0120", False), ("", True)) if all(self._letters(w, s) == self.whole(w[1:] if w[:1] == "\x00" else f" {w}") for w in _PROBES)), None)
        #: Whether such runs, one by one, give the whole library's ids.
        self.runs = False
        self.runs = bool(self.spelling) and not self.spelling[1] and all(self._runs(t) == self.whole(t[1:] if t[:1] == "\x00" else f" {t}") for t in _CUT_PROBES)
        self.cuts = all(self.joined(t) == self.whole(t) for t in _TEXTS)

    def _letters(self, piece: str, spelling: tuple[str, bool]) -> bytes:
        word = piece[1:] if piece[:1] == "\x00" else piece
        if spelling[1]:
            word = word.lower()
        head = "" if piece[:1] == "\x00" else spelling[0]
        return array("I", [t.id for t in self.model.tokenize(head + (word if word.isascii() else word.translate(_SPELT)))]).tobytes()

    def _runs(self, piece: str) -> bytes:
        runs = _CLASS_RUN.findall(piece)
        if len(runs) == 1:
            return self._letters(piece, self.spelling)
        if piece[0] != "\x00":
            return self.pieces[runs[0]] + b"".join([self.pieces["\x00" + x] for x in runs[1:]])
        return b"".join([self.pieces["\x00" + x] for x in runs])

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def piece(self, piece: str) -> bytes:
        """Ids of a piece. It stands for itself after a space; one that begins its text, or a line, is marked with a
        leading NUL."""
        if self.spelling and _PLAIN.fullmatch(piece):
            return self._letters(piece, self.spelling)
        if self.runs and _CUT.fullmatch(piece):
            return self._runs(piece)
        if len(parts := self._parts(piece)) > 1:
            return b"".join([self.pieces[x] for x in parts])
        return self.whole(piece[1:] if piece[:1] == "\x00" else f" {piece}")

    def joined(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ("\x00" + _LINE.sub(" \x00\n \x00", _STOP.sub(" \x00\\g<0>", text))).split(" ")))

    def plain(self, text: str) -> bytes | None:
        """Ids of a text of letters, digits and marks whose lines and stops can be cut without a look at each; else None."""
        kinds = text.encode().translate(_KINDS)
        if any([x in kinds for x in _NOT_PLAIN]) or kinds[0] in b".\n" or kinds[-1] == 10 or "<|" in text:
            return None
        for old, new in _PLAIN_CUTS:
            text = text.replace(old, new)
        return b"".join(map(self.pieces.__getitem__, f"\x00{text}".split(" ")))

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        out = []
        for t in texts:
            if self.ages and len(self.pieces) > self.most // 2:
                self.pieces.age()
            elif len(self.pieces) > self.most:
                self.pieces.clear()
            if not t:
                out.append(b"")
            elif self.cuts and self.runs and (ids := self.plain(t)) is not None:
                out.append(ids)
            elif not self.cuts or "  " in t or "<|" in t or "\x00" in t or _RUN.search(t):
                out.append(self.whole(t))
            else:
                out.append(self.joined(t))
        return out

    def _found(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces of plain texts, whose only letters are those of _PLAIN."""
        known, older, head, tokenize = self.pieces, self.pieces.older, self.spelling[0], self.model.tokenize
        out = list(map(known.get, pieces))
        for i in [i for i, ids in enumerate(out) if ids is None]:
            piece = pieces[i]
            ids = older.get(piece)
            if ids is None:
                if piece.isalpha():
                    ids = array("I", [t.id for t in tokenize(head + (piece if piece.isascii() else piece.translate(_SPELT)))]).tobytes()
                elif (word := piece.rstrip(_MARKS)).isalpha() and self.runs:
                    ids = known[word] + known[f"\x00{piece[len(word) :]}"]
                else:
                    ids = self.piece(piece)
            known[piece] = out[i] = ids
        return out

    def column(self, texts: pa.StringArray) -> list[np.ndarray]:
        """Ids of each text (null: none). Arrow cuts the plain texts and numbers their pieces, so that a piece is looked up once
        a column, not once a place."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        plain = _plain(texts) if len(texts) and self.cuts and self.runs else np.zeros(len(texts), bool)
        out = [np.empty(0, np.uint32)] * len(texts)
        rest = np.flatnonzero(~plain)
        for i, blob in zip(rest.tolist(), self.batch(texts.take(pa.array(rest)).to_pylist()), strict=True):
            out[i] = np.frombuffer(blob, np.uint32)
        if not plain.any():
            return out
        if len(self.pieces) > self.most // 2:
            self.pieces.age()
        cut = texts.filter(pa.array(plain))
        for old, new in _PLAIN_CUTS:
            cut = pc.replace_substring(cut, old, new)
        cut = pc.split_pattern(pc.binary_join_element_wise("\x00", cut, ""), " ")
        places = cut.flatten().dictionary_encode()
        found = self._found(places.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, size = np.frombuffer(b"".join(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found)) >> 2
        piece = places.indices.to_numpy()
        size, first = size.take(piece), (np.cumsum(size) - size).take(piece)
        end = np.cumsum(size)
        at = np.repeat(first - end + size, size)
        at += np.arange(len(at))
        ids = ids.take(at, mode="clip") if len(at) else ids
        end = np.r_[0, end].take(cut.offsets.to_numpy()).tolist()
        for i, (a, b) in zip(np.flatnonzero(plain).tolist(), pairwise(end), strict=True):
            out[i] = ids[a:b]
        return out

    @staticmethod
    def _parts(piece: str) -> list[str]:
        """Cuts a piece around single line ends and before a last comma or stop after plain letters: places that no token
        reaches over."""
        lines = piece.split("\n")
        if len(lines) > 1 and (not all(lines) or lines[0] == "\x00" or any(c.isspace() for x in lines for c in x)):
            return [piece]
        out = []
        for i, x in enumerate(lines):
            if i:
                out.append("\x00\n")
                x = "\x00" + x
            if x[-1:] in (",", ".") and _LETTERS.fullmatch(x[:-1].lstrip("\x00")):
                out += [x[:-1], "\x00" + x[-1]]
            else:
                out.append(x)
        return out


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str, most: int = 600_000, ages: bool = False) -> Encoder:
    """One encoder per worker and file, so that pieces, `most` at once, stay known from task to task; beyond that all are
    forgotten, or if it `ages` those not asked for lately."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, most, ages)
    return _encoders[path]
