"""Whole texts to token ids with the tokenizers library, by remembering the ids of space-separated pieces.

Both public vocabularies used here cut a text before it is merged, so a text may be taken apart at spaces wherever the
cut is certain to be one of theirs:

* a tokenizer that drops white space (normalizer joins white space, pre-tokenizer keeps words only) may be cut at any space;
* a byte-level tokenizer keeps a single space with the following word, so a cut before a space is exact unless white space stands on
  both sides of that space. A text with such a place, or with a special token's string, is encoded whole.

Any other tokenizer encodes whole texts. The memory of pieces is bounded and holds no long piece; forgetting only costs time.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces remembered in a worker, and the longest piece worth remembering.
REMEMBERED = 400_000
LONGEST = 40
#: Marks that part from the word before them.
MARKS = ".,;:!?"
MARKED = frozenset(MARKS)
#: Characters taken apart at once; a longer text goes in several strides, cut at spaces.
STRIDE = 1 << 23

_BESIDE_SPACE = re.compile(r"\s (?!\S)")
#: White space but spaces and line breaks: in ASCII, and anywhere.
_RARE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
_RARER = _RARE + "\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Stands before a line break between two other characters; texts that have it themselves are encoded whole.
SIGN = "\0"
LINE = SIGN + "\n"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary files: printable ones for themselves, the others from 256 on, in order."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def single_spaced(text: str) -> bool:
    """Whether the only white space is single spaces and line breaks between other characters."""
    if not text or text[0] in " \n" or text[-1] in " \n":
        return False
    if "  " in text or "\n" in text and ("\n\n" in text or " \n" in text or "\n " in text):
        return False
    return not any(c in text for c in (_RARE if text.isascii() else _RARER))


def strides(text: str, size: int = STRIDE) -> Iterator[str]:
    """The text in slices of about ``size`` characters; every slice but the first begins with a space."""
    begin = 0
    while len(text) - begin > size:
        cut = text.find(" ", begin + size)
        if cut < 0:
            break
        yield text[begin:cut]
        begin = cut
    yield text[begin:]


class WordTable:
    """Words met before and their ids (or other numbers of four bytes), in flat arrays. What was not met again by the time it is full is forgotten."""

    def __init__(self) -> None:
        self.words = pa.array([], pa.string())
        self.start = np.empty(0, dtype=np.int32)
        self.size = np.empty(0, dtype=np.int32)
        self.flat = np.empty(0, dtype=np.uint32)
        self.met = np.empty(0, dtype=bool)
        self.long = False

    def find(self, words: pa.Array) -> np.ndarray:
        """The place of each word, -1 for unknown ones."""
        at = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False)
        self.met[at[at >= 0]] = True
        return at

    def add(self, words: pa.Array, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The places of new, different words."""
        n = len(self.words)
        self.words = pa.concat_arrays([self.words, words])
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(sizes, dtype=np.int32) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.flat = np.concatenate([self.flat, flat])
        self.met = np.concatenate([self.met, np.zeros(len(sizes), dtype=bool)])
        self.long = self.long or (len(words) and pc.max(pc.binary_length(words)).as_py() > 4 * LONGEST)
        return np.arange(n, len(self.words), dtype=np.int32)

    def settle(self) -> None:
        """Forget, if there is too much. Places change."""
        full = len(self.words) > REMEMBERED
        if not (full or self.long):
            return
        keep = self.met if full else np.ones(len(self.words), dtype=bool)
        if self.long:
            keep = keep & (pc.binary_length(self.words).to_numpy() <= 4 * LONGEST)
        kept = np.flatnonzero(keep)
        if len(kept) > REMEMBERED // 2:
            kept = kept[-(REMEMBERED // 2) :]
        self.words = self.words.take(pa.array(kept))
        self.flat = gathered(self.flat, self.start[kept], self.size[kept])
        self.size = self.size[kept]
        self.start = np.cumsum(self.size, dtype=np.int32) - self.size
        self.met = np.zeros(len(kept), dtype=bool)
        self.long = False


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces ``flat[start : start + size]`` one after the other. There are few enough for small numbers."""
    ends = np.cumsum(sizes, dtype=np.int32)
    place = np.repeat(starts - (ends - sizes), sizes)
    place += np.arange(len(place), dtype=np.int32)
    return flat.take(place)


class PieceMemory:
    """``encode`` gives each text's ids as little-endian unsigned 32-bit integers. Subclasses say how pieces are encoded.

    ``spaced``: a space belongs to the word behind it. ``worded``: white space is dropped. ``special``: strings that are ids of their own.
    """

    def __init__(self, spaced: bool, worded: bool, special: Sequence[str]) -> None:
        self.spaced, self.worded, self.special = spaced, worded, list(special)
        behind_space = WordTable()
        self.tables = {True: behind_space, False: WordTable() if spaced else behind_space}

    def whole(self, texts: Sequence[str]) -> list[bytes]:
        raise NotImplementedError

    def apart(self, pieces: Sequence[str], spaced: bool) -> list[bytes]:
        """The ids of pieces that stand alone, or behind a space."""
        return self.whole([" " + p for p in pieces] if spaced and self.spaced else pieces)

    def parted(self, letter: str, mark: str) -> bool:
        """Whether a mark is cut from the letter or digit before it."""
        return letter.isalnum()

    def _parts(self, piece: str, spaced: bool) -> list[tuple[bool, str]]:
        """A piece as parts that are tokenized alike on their own, each with or without the space before it.

        A line's first piece comes with the break before it, and a mark parts from the letter or digit before it, unless the
        normalized letter ends in a sign that joins the mark.
        """
        out = []
        if piece.startswith(LINE):
            out.append((False, "\n"))
            piece, spaced = piece[len(LINE) :], False
        marked = len(piece) > 1 and piece[-1] in MARKED and self.parted(piece[-2], piece[-1])
        out.append((spaced, piece[:-1] if marked else piece))
        if marked:
            out.append((False, piece[-1]))
        return out

    def _places(self, words: pa.Array, spaced: bool, whole: bool = False) -> np.ndarray:
        """Where different words stand in the table of their kind; unknown ones are encoded, with ``whole`` as they are, else part by part."""
        table = self.tables[spaced]
        at = table.find(words)
        unknown = np.flatnonzero(at < 0)
        if not len(unknown):
            return at
        at = at.copy()
        new = words.take(pa.array(unknown))
        alone: list[int] = []
        joined: list[int] = []
        parts: list[list[tuple[bool, str]]] = []
        texts = new.to_pylist()
        for i, piece in enumerate(texts):
            if whole or piece.isalpha():
                alone.append(i)
            elif piece[-1:] in MARKED and piece[:-1].isalpha() and self.parted(piece[-2], piece[-1]):  # most others: a word and its mark
                joined.append(i)
                parts.append([(spaced, piece[:-1]), (False, piece[-1])])
            else:
                found = self._parts(piece, spaced)
                if len(found) > 1:
                    joined.append(i)
                    parts.append(found)
                else:
                    alone.append(i)
        if alone:
            values = self.apart([texts[i] for i in alone], spaced)
            sizes = np.fromiter(map(len, values), dtype=np.int32, count=len(values)) >> 2
            at[unknown[alone]] = table.add(new.take(pa.array(alone)), np.frombuffer(b"".join(values), dtype="<u4"), sizes)
        if joined:
            starts, sizes = self._found([x for few in parts for x in few])
            counts = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
            of_piece = np.add.reduceat(sizes, np.cumsum(counts) - counts, dtype=np.int32)
            at[unknown[joined]] = table.add(new.take(pa.array(joined)), gathered(self._flat(), starts, sizes), of_piece)
        return at

    def _flat(self) -> np.ndarray:
        """The ids of all tables one after the other."""
        return np.concatenate([self.tables[True].flat, self.tables[False].flat]) if self.spaced else self.tables[True].flat

    def _found(self, parts: list[tuple[bool, str]]) -> tuple[np.ndarray, np.ndarray]:
        """(begin in ``_flat``, number of ids) of every part."""
        kinds = np.fromiter((x for x, _ in parts), dtype=bool, count=len(parts))
        texts = pa.array([t for _, t in parts], pa.string())
        places = np.empty(len(parts), dtype=np.int32)
        for kind in (True, False):
            rows = np.flatnonzero(kinds == kind)
            if len(rows):
                coded = texts.take(pa.array(rows)).dictionary_encode()
                places[rows] = self._places(coded.dictionary, kind, whole=True)[coded.indices.to_numpy()]
        starts, sizes = np.empty_like(places), np.empty_like(places)
        for kind in (True, False):
            rows = kinds == kind
            before = len(self.tables[True].flat) if self.spaced and not kind else 0
            starts[rows], sizes[rows] = self.tables[kind].start[places[rows]] + before, self.tables[kind].size[places[rows]]
        return starts, sizes

    def _apart(self, texts: Sequence[str]) -> list[bytes]:
        """Arrow cuts the texts, numbers their distinct pieces and looks them up; only unknown ones are looked at one by one."""
        split = pc.split_pattern(pa.array(texts, type=pa.string()), " ")
        offsets = split.offsets.to_numpy()
        coded = split.values.dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int32)
        places = self._places(coded.dictionary, True)
        if self.spaced:
            # The first piece of a text has no space before it: it counts as a piece of another kind.
            heads, which = np.unique(at[offsets[:-1]], return_inverse=True)
            first = self._places(coded.dictionary.take(pa.array(heads)), False)
            at[offsets[:-1]] = len(places) + which
        table = self.tables[True]
        starts, sizes = table.start[places], table.size[places]
        if self.spaced:
            other = self.tables[False]
            starts = np.concatenate([starts, other.start[first] + np.int32(len(table.flat))])
            sizes = np.concatenate([sizes, other.size[first]])
        size = sizes[at]
        ids = gathered(self._flat(), starts[at], size).tobytes()
        stops = np.concatenate([[0], np.cumsum(size, dtype=np.int32)])[offsets].tolist()
        for each in self.tables.values():
            each.settle()
        return [ids[4 * x : 4 * y] for x, y in zip(stops[:-1], stops[1:], strict=True)]

    def _plain(self, text: str) -> str | None:
        """The text as it may be cut at spaces, or None where that would not be exact.

        Line breaks become spaces, or a space and a sign; where case does not count, Latin-1 (which nothing composes or decomposes)
        becomes small.
        """
        if self.worded:
            if any(s in text for s in self.special):
                return text
            text = text.replace("\n", " ")
            if not text.isascii():
                try:
                    text.encode("latin-1")
                except UnicodeEncodeError:
                    return text
            small = text.lower()
            # What only looks like a special string must not become one.
            return text if any(s in small for s in self.special) else small
        if not self.spaced or SIGN in text or any(s in text for s in self.special):
            return None
        if single_spaced(text):
            return text.replace("\n", " " + LINE)
        return None if _BESIDE_SPACE.search(text) else text

    def encode(self, texts: Sequence[str], stride: int | None = None) -> list[bytes]:
        """The ids of each text. Pieces are looked up for about ``stride`` characters at once: more at a time is faster and takes more memory."""
        stride = stride or STRIDE
        out: list[bytes] = [b""] * len(texts)
        group: list[tuple[int, str]] = []
        size = 0

        def flush() -> None:
            for (i, _), ids in zip(group, self._apart([s for _, s in group]), strict=True):
                out[i] += ids
            group.clear()

        for i, text in enumerate(texts):
            if not text:
                continue
            plain = self._plain(text)
            if plain is None:
                out[i] = self.whole([text])[0]
                continue
            for part in strides(plain, stride):
                # A later slice begins with the space before its first piece, which splitting turns into an empty head.
                group.append((i, part))
                size += len(part)
                if size >= stride:
                    flush()
                    size = 0
        if group:
            flush()
        # Workers live on through other stages, and pieces of text are freed memory that Arrow would keep.
        pa.default_memory_pool().release_unused()
        return out


class PieceTokenizer(PieceMemory):
    """A tokenizer file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task uses one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        steps = [x.get("type") for x in before.get("pretokenizers", [])]
        replaced = [x for x in (spec.get("normalizer") or {}).get("normalizers", []) if x.get("type") == "Replace"]
        bytes_only = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        words_only = steps[:1] == ["Split"] and before["pretokenizers"][0].get("behavior") == "Removed"
        super().__init__(
            spaced=bool(bytes_only and not spec.get("normalizer")),
            worded=words_only and any(x["pattern"] == {"Regex": "\\s+"} for x in replaced),
            special=[x["content"] for x in spec.get("added_tokens", [])],
        )
        letters = byte_letters()
        self.marks_parted: dict[str, bool] = {}
        self.letter = {b: c for c, b in letters.items()}.__getitem__
        self.before = self.letter(32) if self.spaced else ""
        self.model = self.tokenizer.model

    def whole(self, texts: Sequence[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def parted(self, letter: str, mark: str) -> bool:
        """What the tokenizer's own normalizer and pre-tokenizer do, remembered for each letter."""
        if letter.isascii():
            return letter.isalnum()
        found = self.marks_parted.get(letter + mark)
        if found is None:
            normalizer = self.tokenizer.normalizer
            text = f"a{letter}{mark}"
            pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(normalizer.normalize_str(text) if normalizer else text)
            found = self.marks_parted[letter + mark] = letter.isalnum() and bool(pieces) and pieces[-1][0] == mark
        return found

    def apart(self, pieces: Sequence[str], spaced: bool) -> list[bytes]:
        """Latin-1 words (small ones, where case does not count) are words of the vocabulary's model as they stand."""
        if not (self.spaced or self.worded):
            return super().apart(pieces, spaced)
        out: list[bytes | None] = []
        before = self.before if spaced else ""
        tokenize, letter, any_case = self.model.tokenize, self.letter, self.spaced
        for p in pieces:
            if p.isalpha() and (any_case or p.islower()):
                if not p.isascii():
                    try:
                        p.encode("latin-1")
                    except UnicodeEncodeError:
                        out.append(None)
                        continue
                    p = "".join(map(letter, p.encode()))
                out.append(array("I", [t.id for t in tokenize(before + p)]).tobytes())
            else:
                out.append(None)
        others = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(others, super().apart([pieces[i] for i in others], spaced), strict=True):
            out[i] = ids
        return out


_LOADED: dict[str, PieceTokenizer] = {}


def tokenizer_at(path: str) -> PieceTokenizer:
    """One tokenizer for each file and Python worker, so that its memory serves all tasks of the worker."""
    if path not in _LOADED:
        _LOADED[path] = PieceTokenizer(path)
    return _LOADED[path]
