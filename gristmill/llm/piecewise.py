"""Whole texts through tokenizer libraries, a stretch at a time.

A tokenizer that never joins bytes across certain places gives the same ids for a text
as for its stretches between them.  Each stretch is encoded by the library itself, and
a worker remembers the ids of short ones, as words repeat.  Texts with white space on
which engines may differ are handed to the library whole.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Callable

import numpy as np

#: Stretches up to so many characters are remembered, and so many of them; then the memory starts anew.  So many new ones are encoded as one text.
REMEMBERED_LENGTH, REMEMBERED, AT_ONCE = 40, 1 << 19, 2000
#: White space beyond ASCII's, and characters that some engines take for it: such texts are encoded whole.
_UNUSUAL = re.compile("[\x00\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
_LETTERS, _STOPS = "[A-Za-zÀ-ÖØ-öø-ÿ]++", r"[.,;:!?]++(?=\s|\Z)"
#: Letters before closing stops, such stops, other words.
_WORD = re.compile(rf"{_LETTERS}(?={_STOPS})|{_STOPS}|\S+")
#: The same with the blank before a word; white space up to the last one before a word; that one, unless it is a blank.
_WORD_AND_BLANK = re.compile(rf" ?{_LETTERS}(?={_STOPS})|{_STOPS}| ?\S+|\s+(?!\S)|\s")
#: Stretches whose UTF-8 length no normalisation to composed lower case changes.
_PLAIN, _PLAIN_AFTER_BLANK = re.compile("[!-~À-ÿ]+"), re.compile(" [!-~À-ÿ]+")
#: Blanks or one line break with what follows.
_FROM_BLANK = re.compile(r" +[^ \n]*|\n[^ \n]*")
#: SentencePiece's mark of a blank.
BLANK = "\u2581"


class Piecewise:
    """Ids of whole texts from the ids of their stretches."""

    def __init__(self, cut: Callable[[str], list[str]], encode: Callable[[list[str]], list[bytes]]):
        self._cut, self._encode, self._known = cut, encode, {}

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """One array of unsigned 32-bit ids a text."""
        cut = [self._cut(text) for text in texts]
        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        new = [s for s in set().union(*cut) if s not in known]
        known.update(zip(new, self._encode(new) if new else ()))
        out = [np.frombuffer(b"".join(map(known.__getitem__, stretches)), "<u4") for stretches in cut]
        for stretch in new:
            if len(stretch) > REMEMBERED_LENGTH:
                del known[stretch]
        return out


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    return library


def _token_bytes(library, end_of_word: str = "") -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary."""
    alphabet = {c: b for b, c in _byte_characters().items()}
    entries = library.get_vocab(with_added_tokens=True)
    tokens = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        own = entry.removesuffix(end_of_word)
        tokens[i] = bytes(alphabet[c] for c in own) if all(c in alphabet for c in own) else entry.encode()
    return tokens


def _many(library, tokens: list[bytes], plain: re.Pattern, glue: str) -> Callable[[list[str]], list[bytes]]:
    """Encode many stretches: plain ones joined to long texts and cut again by the bytes of their tokens, the others each on its own."""
    sizes = np.array([len(t) for t in tokens], np.int64)

    def encode(stretches: list[str]) -> list[bytes]:
        own: dict[str, bytes] = {}
        joined = [s for s in stretches if plain.fullmatch(s)]
        parts = [joined[i : i + AT_ONCE] for i in range(0, len(joined), AT_ONCE)]
        coded = library.encode_batch_fast([glue.join(part) for part in parts], add_special_tokens=False) if parts else []
        for part, code in zip(parts, coded):
            ids = np.array(code.ids, "<u4")
            ends, want = np.cumsum(sizes[ids]), np.cumsum([len(s.encode()) for s in part])
            after = np.searchsorted(ends, want) + 1
            if len(ids) == after[-1] and (ends[after - 1] == want).all():
                raw, cuts = ids.tobytes(), (4 * np.concatenate([[0], after])).tolist()
                own.update(zip(part, (raw[a:b] for a, b in zip(cuts[:-1], cuts[1:]))))
        rest = [s for s in stretches if s not in own]
        for stretch, code in zip(rest, library.encode_batch(rest, add_special_tokens=False) if rest else ()):
            own[stretch] = np.array(code.ids, "<u4").tobytes()
        return [own[s] for s in stretches]

    return encode


@functools.cache
def words(path: str) -> Piecewise:
    """A lower-casing byte-level tokenizer of the `tokenizers` library whose words end in a mark and that drops white space."""
    library = _library(path)
    encode = _many(library, _token_bytes(library, "</w>"), _PLAIN, " ")
    return Piecewise(lambda text: [text] if _UNUSUAL.search(text) else _WORD.findall(_ascii_lower(text)), encode)


def _ascii_lower(text: str) -> str:
    """A-Z in lower case, nothing else changed: what a lower-casing tokenizer would do anyway."""
    return text.encode().lower().decode()


@functools.cache
def byte_level(path: str) -> tuple[Piecewise, list[bytes]]:
    """A byte-level tokenizer of the `tokenizers` library whose words take the blank before them, and the bytes of its tokens."""
    library = _library(path)
    tokens = _token_bytes(library)
    return Piecewise(lambda text: [text] if _UNUSUAL.search(text) else _WORD_AND_BLANK.findall(text), _many(library, tokens, _PLAIN_AFTER_BLANK, "")), tokens


def _byte_characters() -> dict[int, str]:
    """Byte to the character that stands for it in byte-level vocabularies: itself where it prints, else the next one from U+0100."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.cache
def sentence_pieces(path: str) -> tuple[Piecewise, list[bytes]]:
    """A SentencePiece model, for texts that begin with the blank it would add, and the bytes of its pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens, whole = [], False
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        tokens.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(BLANK, " ").encode())
        # a piece with a blank behind another character, or a line break, could join two stretches
        whole |= not model.is_control(i) and (BLANK in piece.lstrip(BLANK) or "\n" in piece)
    mark = model.encode("\n")[:1]
    whole |= len(model.encode("\n")) != 2 or model.id_to_piece(mark) != [BLANK]

    def encode(stretches: list[str]) -> list[bytes]:
        coded = model.encode([s[1:] if s[:1] == " " else s for s in stretches], num_threads=1)
        own = (mark if s == " " else ids if s[:1] == " " else ids[1:] for s, ids in zip(stretches, coded))
        return [np.array(ids, "<u4").tobytes() for ids in own]

    return Piecewise(lambda text: [text] if whole or _UNUSUAL.search(text) else _FROM_BLANK.findall(text), encode), tokens
