r"""Token ids of whole texts by the ``tokenizers`` library, each distinct word of a group of texts encoded once.

A text is cut only where the vocabulary's own splitting rule always cuts, so the ids are those
of encoding it whole:

* ``spaces="part"`` (byte-level vocabularies): before a single space or newline between two
  other characters. Texts with any other white space are given to the library whole.
* ``spaces="dropped"`` (vocabularies that drop white space): at every space and newline.

Latin letters with ASCII signs after them are a stem and an end under that rule, and the library's
model gets each distinct stem and end straight away; other words go through the whole library.

Stems that a group of texts holds more than once stay in the Python worker, up to ``MAX_STEMS`` of
them; most words that are new to a group are rare, so that keeping all costs memory and saves little.
Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import kept

MAX_STEMS = 100_000
#: Texts are encoded together up to about this many characters.
BATCH_CHARS = 2_000_000
#: Letters that folding and composing leave alone or map one to one, and all ASCII signs.
_LETTERS, _SIGNS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F", "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Of cut parts "\0" marks a text's first word, which has no space before it, "\n" a line's, which has the newline.
_MARK = r"^[\x00\n]?"
_OTHER_SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]
_ODD = ["\0", "  ", " \n", "\n ", "\n\n"]


def cuts_anywhere(text: str) -> bool:
    """Whether every space and newline of a text stands alone between two other characters, and no other white space is there."""
    return not (text[0] in " \n" or text[-1] in " \n" or any(x in text for x in _ODD) or any(c in text for c in _OTHER_SPACES))


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _runs(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` that begin at ``starts``, one after the other."""
    upto = np.cumsum(sizes)
    total = int(upto[-1]) if len(upto) else 0
    return ids[np.repeat(starts - (upto - sizes), sizes) + np.arange(total)]


class WordEncoder:
    def __init__(self, path: str, spaces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.part = {"part": True, "dropped": False}[spaces]
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.stem = (_MARK if self.part else "^") + f"[{_LETTERS}]+"
        self.newline = self._whole(["\n"])[0]
        self.places: dict[str, int] = {}
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, piece: str, head: str = "") -> list[int]:
        piece = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(head + piece)]

    def _stem(self, stem: str) -> list[int]:
        if not self.part:
            return self._piece(stem.lower())
        if stem[0] == "\n":
            return self.newline + self._piece(stem[1:])
        return self._piece(stem[1:]) if stem[0] == "\0" else self._piece(stem, self.letters[32])

    def _odd(self, words: list[str]) -> list[list[int]]:
        if self.part:
            words = [w[1:] if w[:1] == "\0" else w if w[:1] == "\n" else " " + w for w in words]
        return self._whole(words)

    def _stems(self, stems: pa.DictionaryArray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct stems: all in a row, and where each one's are and how many."""
        names = stems.dictionary.to_pylist()
        at = np.fromiter(map(self.places.get, names, repeat(-1)), np.int64, len(names))
        new = np.nonzero(at < 0)[0]
        found = [self._stem(names[k]) for k in new.tolist()]
        own = np.fromiter(map(len, found), np.int64, len(found))
        mine = np.fromiter((i for ids in found for i in ids), np.uint32, int(own.sum()))
        starts, sizes = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        known = at >= 0
        starts[known], sizes[known] = self.starts[at[known]], self.sizes[at[known]]
        starts[new], sizes[new] = len(self.ids) + np.cumsum(own) - own, own
        ids = np.concatenate([self.ids, mine])
        often = np.bincount(np.asarray(stems.indices), weights=counts, minlength=len(names))[new] > 1
        keep = new[often][: MAX_STEMS - len(self.places)]
        if len(keep):
            n, used = len(self.places), len(self.ids)
            self.ids = np.concatenate([self.ids, _runs(ids, starts[keep], sizes[keep])])
            self.starts = np.concatenate([self.starts, used + np.cumsum(sizes[keep]) - sizes[keep]])
            self.sizes = np.concatenate([self.sizes, sizes[keep]])
            self.places.update(zip([names[k] for k in keep.tolist()], range(n, n + len(keep))))
        return ids, starts, sizes

    def _learn(self, words: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of distinct words, of which there are ``counts``."""
        starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        is_simple = pc.match_substring_regex(words, self.stem + r"[!-/:-@\[-`{-~]*$")
        at = np.nonzero(np.asarray(is_simple))[0]
        simple = words.filter(is_simple)
        stems = pc.utf8_rtrim(simple, _SIGNS)
        ends = pc.replace_substring_regex(simple, self.stem, "").dictionary_encode()
        stems = stems.dictionary_encode()
        of_stems, stem_at, stem_n = self._stems(stems, counts[at])
        of_ends = [self._piece(e) if e else [] for e in ends.dictionary.to_pylist()]
        end_n = np.fromiter(map(len, of_ends), np.int64, len(of_ends))
        end_at = len(of_stems) + np.cumsum(end_n) - end_n
        s, e = np.asarray(stems.indices), np.asarray(ends.indices)
        two = lambda a, b: np.stack([a[s], b[e]], axis=1).ravel()
        flat = _runs(np.concatenate([of_stems, np.fromiter((i for x in of_ends for i in x), np.uint32, int(end_n.sum()))]), two(stem_at, end_at), two(stem_n, end_n))
        sizes[at] = stem_n[s] + end_n[e]
        odd = np.nonzero(~np.asarray(is_simple))[0]
        found = self._odd(words.take(pa.array(odd)).to_pylist())
        sizes[odd] = np.fromiter(map(len, found), np.int64, len(found))
        order = np.concatenate([at, odd])
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate([flat, np.fromiter((i for x in found for i in x), np.uint32, int(sizes[odd].sum()))]), starts, sizes

    def _by_words(self, texts: list[str]) -> list[np.ndarray]:
        lines = pa.array(["\0" + t for t in texts] if self.part else texts, pa.large_string())
        cut = pc.split_pattern(pc.replace_substring(lines, "\n", " \n" if self.part else " "), " ")
        words = cut.flatten().dictionary_encode()
        at = np.asarray(words.indices)
        ids, starts, sizes = self._learn(words.dictionary, np.bincount(at, minlength=len(words.dictionary)))
        flat = _runs(ids, starts[at], sizes[at])
        upto = np.concatenate([[0], np.cumsum(sizes[at])])
        bounds = upto[np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(cut)))])]
        return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids (unsigned 32-bit) of each text."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        todo = [k for k, t in enumerate(texts) if t]
        if self.part:
            whole = [k for k in todo if not cuts_anywhere(texts[k])]
            if whole:
                for k, e in zip(whole, self.tokenizer.encode_batch_fast([texts[k] for k in whole], add_special_tokens=False)):
                    out[k] = np.array(e.ids, dtype=np.uint32)
                odd = set(whole)
                todo = [k for k in todo if k not in odd]
        if todo:
            for k, ids in zip(todo, self._by_words([texts[k] for k in todo])):
                out[k] = ids
        return out


def encoder(path: str, spaces: str) -> WordEncoder:
    """The worker's own encoder, kept between tasks."""
    return kept(("encoder", path, spaces), lambda: WordEncoder(path, spaces))


def encoded(rows: Iterable[tuple], enc: WordEncoder, end_id: int) -> Iterator[tuple]:
    """``(key, ids)`` of each ``(key, text)``, the end id appended; a bounded group of texts at a time."""
    keys: list = []
    texts: list[str] = []
    size = 0

    def flush() -> Iterator[tuple]:
        for key, ids in zip(keys, enc.encode(texts)):
            yield key, np.append(ids, np.uint32(end_id))

    for key, text in rows:
        keys.append(key)
        texts.append(text or "")
        size += len(texts[-1])
        if size >= BATCH_CHARS:
            yield from flush()
            keys, texts, size = [], [], 0
    yield from flush()
