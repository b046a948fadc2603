"""Token ids of whole texts, as a tokenizer's library gives them, from encoded pieces.

Most of a corpus is made of words seen before.  Where a tokenizer never looks across the
white space between two words, the ids of a text are those of its pieces in a row, and a
task encodes every different piece only once.  What a piece is depends on the tokenizer:
one that drops white space is cut at ASCII white space; a byte-level one keeps each run of
it together with the word that follows.  Other texts are encoded whole.

Where a tokenizer also ignores case and parts punctuation from letters, a piece that is new
is looked up once more as its letters in lower case and the punctuation after them, so that
*Word*, *word,* and *word.* are encoded once, by the tokenizer's model alone.  Whether this
gives what the whole tokenizer does is tried, letter by letter, when it is loaded.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array

import numpy as np

HELD = 400_000  # pieces of a generation, about 80 MB, and as many words
LONGEST = 64  # bytes of a piece that is held
LINE = 250  # pieces that are encoded as one text

#: Letters of ASCII and Latin-1, and plain punctuation after them.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
PUNCTUATION = ".,;:!?"
PLAIN_PIECE = re.compile(rf"([{LETTERS}]+)([{PUNCTUATION}]{{0,2}})")
#: A run of plain white space and what follows it.
BYTE_LEVEL_PIECE = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+")
#: What some definition counts as white space beside the four above, or ignores.
OTHER_SPACE = re.compile(
    r"[^\S \t\r\n]|[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]"
)


def _parts(ids: list[int], of: np.ndarray, n: int) -> list[bytes]:
    """The ids of each of ``n`` pieces, where ``of`` is the piece of each id, ascending."""
    ends = (np.cumsum(np.bincount(of, minlength=n)) * 4).tolist()
    joined, start, parts = np.asarray(ids, "<u4").tobytes(), 0, []
    for end in ends:
        parts.append(joined[start:end])
        start = end
    return parts


class PieceEncoder:
    """Encodes texts with a ``tokenizers`` file, with a cache of pieces.

    No begin, end or other special tokens are added; special strings within a text are
    handled as the library does by default; nothing is truncated or padded.  Pieces used
    lately are held in two generations of at most ``held`` each.
    """

    def __init__(self, path: str, held: int = HELD):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # the model's own cache is smaller than those here, and looking words up takes its time
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.drops_space = self._drops_space()
        self.parts_letters = self.drops_space and self._parts_letters()
        self.words: dict = {}
        self.old_words: dict = {}
        self.marks: dict = {"": b""}
        self.held = held
        self.young: dict = {}
        self.old: dict = {}

    def _drops_space(self) -> bool:
        whole, *parts = (self.tokenizer.encode(x, add_special_tokens=False).ids for x in ("ab  cd\n\tab", "ab", "cd"))
        return whole == parts[0] + parts[1] + parts[0]

    def _parts_letters(self) -> bool:
        """Whether the case of letters does not matter, punctuation after letters is encoded as if
        it stood alone, and the model gives letters the ids that the whole tokenizer does."""
        ids = lambda x: self.tokenizer.encode(x, add_special_tokens=False).ids
        letters = [c for c in map(chr, range(256)) if PLAIN_PIECE.fullmatch(c)]
        marks = [*PUNCTUATION, *(a + b for a in PUNCTUATION for b in PUNCTUATION)]
        words = ["the", "aren", "qzjw", "".join(letters).lower(), *(c.lower() + "a" + c.lower() for c in letters), *map(str.lower, letters)]
        from tokenizers.pre_tokenizers import ByteLevel

        spelled = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {ord(c): spelled(c)[0][0] for c in letters}
        return (
            all(ids(c) == ids(c.lower()) for c in letters)
            and all(ids(word) == self._word_ids(word) for word in words)
            and all(ids(word + mark) == ids(word) + ids(mark) for word in words for mark in marks)
        )

    def _word_ids(self, word: str) -> list[int]:
        """The ids of a word of lower-case letters."""
        return [token.id for token in self.tokenizer.model.tokenize(word.translate(self.spelling))]

    def _ids(self, pieces: list) -> list[bytes]:
        """The ids of each piece."""
        if not self.parts_letters:
            return self._whole_ids(pieces)
        split = [PLAIN_PIECE.fullmatch(p.decode()) if len(p) <= LONGEST else None for p in pieces]
        other = [p for p, found in zip(pieces, split) if found is None]
        others = iter(self._whole_ids(other) if other else [])
        keys = [found and (found[1].lower(), found[2]) for found in split]
        words, old, tokenize, spelling = self.words, self.old_words, self.tokenizer.model.tokenize, self.spelling
        for word in dict.fromkeys(key[0] for key in keys if key and key[0] not in words):
            ids = old.get(word)
            if ids is None:
                ids = array("I", [token.id for token in tokenize(word.translate(spelling))]).tobytes()
            words[word] = ids
        marks = {key[1] for key in keys if key} - self.marks.keys()
        if marks:
            self.marks.update(zip(marks, self._whole_ids([m.encode() for m in marks])))
        found = [words[key[0]] + self.marks[key[1]] if key else next(others) for key in keys]
        if len(words) > self.held:
            self.old_words, self.words = words, {}
        return found

    def _whole_ids(self, pieces: list) -> list[bytes]:
        """The ids of each piece, encoded as it is."""
        if not self.drops_space:
            found = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
            return _parts(found.ids, np.asarray(found.word_ids, np.int64), len(pieces))
        # lines of some pieces: the library takes longer over longer ones
        words = [p.decode() for p in pieces]
        lines = [words[i : i + LINE] for i in range(0, len(words), LINE)]
        parts = []
        for line, found in zip(lines, self.tokenizer.encode_batch([" ".join(x) for x in lines], add_special_tokens=False)):
            starts = np.cumsum([0, *(len(w) + 1 for w in line[:-1])])
            at = np.fromiter((start for start, _ in found.offsets), np.int64, len(found))
            parts += _parts(found.ids, np.searchsorted(starts, at, "right") - 1, len(line))
        return parts

    def pieces(self, text: str) -> list:
        """Pieces whose ids in a row are those of the text."""
        if self.drops_space:
            return text.encode().split()  # bytes are split at ASCII white space only
        if OTHER_SPACE.search(text):
            return [text] if text else []
        return BYTE_LEVEL_PIECE.findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        split = [self.pieces(text) for text in texts]
        pieces = [p for of_text in split for p in of_text]
        ids = list(map(self.young.get, pieces))
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            needed = dict.fromkeys([pieces[i] for i in missing])
            added = {p: self.old[p] for p in needed if p in self.old}
            new = [p for p in needed if p not in added]
            if new:
                added.update(zip(new, self._ids(new)))
            for i in missing:
                ids[i] = added[pieces[i]]
            self.young.update(added)
            for piece in [p for p in added if len(p) > LONGEST]:
                del self.young[piece]
            if len(self.young) > self.held:
                self.old, self.young = self.young, {}
        found, at = [], 0
        for of_text in split:
            found.append(b"".join(ids[at : at + len(of_text)]))
            at += len(of_text)
        return found

    def count(self, texts: list[str]) -> list[int]:
        """The number of ids of each text."""
        return [len(ids) // 4 for ids in self.encode(texts)]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The encoder of this process, which later tasks find warm."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer's file and its library's version: counts of one digest
    are comparable."""
    import tokenizers

    with open(path, "rb") as file:
        content = file.read()
    return hashlib.sha256(content + f"\ntokenizers {tokenizers.__version__}".encode()).hexdigest()
