"""Token ids of whole texts by a public tokenizer file, for use inside tasks.

A byte-level BPE file splits texts into parts before it merges. Texts are cut at places
where such a part always ends, so that each distinct piece is encoded once per worker
and then looked up. The ids equal those of encoding the whole text at once.
"""

import functools
import json
import re
import struct
from collections.abc import Callable

#: Letters that every tokenizer pattern counts as letters (Latin, Latin-1, Extended-A).
LETTER = "A-Za-zÀ-ÖØ-öø-ſ"
#: Safe places: before a single space between two words, after a run of letters, and after
#: a line feed between two characters that are no white space.
CUT = re.compile(rf"(?<=\S)(?= \S)|(?<=[{LETTER}])(?=\W)|(?<=\S\n)(?=\S)")
SINGLE, LETTERS = re.compile(rf" ?[{LETTER}]+"), re.compile(rf"[{LETTER}]+")
ENDED = re.compile(rf"([{LETTER}]+)([!-/:-@\[-`{{-~]+)")
#: A part always ends before a single space between two other characters as well.
SPACES = [c for c in map(chr, range(0x3001)) if c.isspace()]
SINGLE_SPACE = re.compile(r" (?<=\S )(?=\S)")
#: Characters per slice of a long text, bytes of remembered pieces per worker, longest one.
SLICE = 1 << 20
KEPT_BYTES, KEPT_PIECE = 160 << 20, 64
#: The space as byte-level vocabularies show it.
SPACE = "\u0120"


def byte_characters() -> dict[int, int]:
    """Byte -> code point of byte-level vocabularies (fixed public map)."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: b for b in shown}, **{b: 256 + i for i, b in enumerate(hidden)}}


def long_slices(text: str, most: int = SLICE):
    """Slices of a text, cut at safe places only; a run without one stays whole."""
    start = 0
    while len(text) - start > most:
        found = CUT.search(text, start + most)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def split_at_spaces(text: str) -> list[str]:
    """A text cut at its single spaces, which are left out."""
    alone = not any(c in text and (" " + c in text or c + " " in text) for c in SPACES)
    return text.split(" ") if alone else SINGLE_SPACE.split(text)


class Learned(dict):
    """A dictionary whose missing values are made, and kept, by a function."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, name: str) -> bytes:
        return self.make(name)


class Subwords:
    """A tokenizer file: ``.json`` by tokenizers, ``.model`` by sentencepiece."""

    def __init__(self, path: str):
        self.pieces, self.words, self.kept = Learned(self.piece), Learned(self.spaced), 0
        self.table = byte_characters()
        self.by_piece = False
        if path.endswith(".model"):
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode_all = lambda texts: self.model.encode(texts, num_threads=1)
            return
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.encode_all = lambda texts: [
            x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]
        with open(path, encoding="utf-8") as file:
            setup = json.load(file)
        before, model, added = setup["pre_tokenizer"] or {}, setup["model"], setup["added_tokens"]
        self.by_piece = (
            setup["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and model["type"] == "BPE"
            and not model.get("dropout")
            and not any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in added)
        )
        self.added = {x["content"]: struct.pack("<I", x["id"]) for x in added}
        names = sorted(self.added, key=len, reverse=True)
        self.find_added = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.model = self.tokenizer.model

    def segments(self, text: str):
        """Pieces of a text; the strings of added tokens stand alone."""
        if not text:
            return []
        if self.find_added and self.find_added.search(text):
            parts = self.find_added.split(text)
        else:
            parts = [text]
        out = []
        for part in parts:
            if part in self.added:
                out.append(part)
            elif part:
                for piece in long_slices(part):
                    out += CUT.split(piece)
        return out

    def remember(self, known: dict[str, bytes], name: str, ids: bytes) -> bytes:
        """Keep the ids of a short string within the budget of this worker."""
        if len(name) <= KEPT_PIECE:
            if self.kept > KEPT_BYTES:
                self.pieces.clear()
                self.words.clear()
                self.kept = 0
            known[name] = ids
            self.kept += 160 + len(name) + len(ids)
        return ids

    def new_ids(self, piece: str) -> bytes:
        """Ids of a piece that nothing is known of."""
        if piece in self.added:
            return self.added[piece]
        if SINGLE.fullmatch(piece):
            shown = piece.replace(" ", SPACE)
            if not piece.isascii():
                shown = piece.encode().decode("latin-1").translate(self.table)
            ids = [token.id for token in self.model.tokenize(shown)]
        else:
            ids = self.encode_all([piece])[0]
        return struct.pack(f"<{len(ids)}I", *ids)

    def piece(self, piece: str) -> bytes:
        return self.remember(self.pieces, piece, self.new_ids(piece))

    def spaced(self, word: str) -> bytes:
        """Ids of a word and the single space before it."""
        if LETTERS.fullmatch(word):
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.table)
            ids = [token.id for token in self.model.tokenize(SPACE + shown)]
            return self.remember(self.words, word, struct.pack(f"<{len(ids)}I", *ids))
        ended = ENDED.fullmatch(word)
        if ended:
            # a word and the marks after it are parts of their own
            return self.words[ended[1]] + self.pieces[ended[2]]
        return b"".join(map(self.pieces.__getitem__, self.segments(" " + word)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if not self.by_piece:
            return [struct.pack(f"<{len(ids)}I", *ids) for ids in self.encode_all(texts)]
        found = []
        for text in texts:
            first, rest = text, []
            if not (self.find_added and self.find_added.search(text)):
                first, *rest = split_at_spaces(text)
            head = b"".join(map(self.pieces.__getitem__, self.segments(first)))
            found.append(head + b"".join(map(self.words.__getitem__, rest)))
        return found


@functools.cache
def subwords(path: str) -> Subwords:
    """One encoder per worker and file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Subwords(path)
