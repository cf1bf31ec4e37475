"""BPE encoding by backtracking over longest matches; decoding by an offset table."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from airstrata.llm.common import batches

# Stands for the end-of-word suffix, so that it is one position of a piece. It is no letter of
# the byte alphabet.
END = ""
# White space of the tokenizers; Python's own splits at U+001C to U+001F as well.
SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = regex.compile(f"[{SPACE}]+")
SEPARATORS = regex.compile("[\x1c-\x1f]")
# Encoded chunks a worker keeps, and the longest chunk it keeps.
CACHE_CHUNKS = 900_000
CACHE_LENGTH = 48


def byte_letters() -> list[str]:
    """The letter of each byte in byte-level vocabularies: itself if printable Latin-1, the
    others from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in printable else spare))
        spare += byte not in printable
    return letters


def unsure(text: str) -> bool:
    """Whether a text holds letters younger than Python's tables, or U+001C to U+001F."""
    if SEPARATORS.search(text):
        return True
    return not text.isascii() and any([unicodedata.category(c) == "Cn" for c in text])


class ChunkCache(dict):
    """What a function gave for recent keys; emptied when full, long keys are not kept."""

    def __init__(self, function, limit: int = CACHE_CHUNKS):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, chunk: str) -> Any:
        value = self.function(chunk)
        if len(chunk) <= CACHE_LENGTH:
            if len(self) >= self.limit:
                self.clear()
            self[chunk] = value
        return value


class PieceEncoder:
    """Exact merges of one piece, without replaying them.

    Tokens are numbered so that the unmerged ones come first and the others follow in order of
    their merges. A sequence of tokens is what the merges give if and only if every two
    neighbours are: the merges would not have joined anything across their border earlier.
    So a piece is walked from the left with the longest token at each position, found by
    following the Aho-Corasick automaton from there; a token that does not fit its left
    neighbour is shortened to its longest prefix token, and where none fits, the position is
    closed and the token before it is shortened. Each position is closed at most once, and no
    match looks further than the longest token: the time is linear in the piece.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        def marked(token: str) -> str:
            ends = suffix and token.endswith(suffix) and token != suffix
            return token[: -len(suffix)] + END if ends else token

        made = [(marked(a), marked(b), marked(a + b)) for a, b in merges]
        merged = {token for _, _, token in made}
        base = [t for t in map(marked, sorted(vocab, key=vocab.get)) if t not in merged]
        ids = {marked(token): number for token, number in vocab.items()}
        self.tokens = [*base, *(token for _, _, token in made)]
        self.number = {token: i for i, token in enumerate(self.tokens)}
        self.ids = [ids[token] for token in self.tokens]
        self.length = [len(token) for token in self.tokens]
        self.unmerged = len(base)
        self.left = list(range(len(base))) + [self.number[a] for a, _, _ in made]
        self.right = list(range(len(base))) + [self.number[b] for _, b, _ in made]
        self.pairs = {
            (self.left[i], self.right[i]): i for i in range(len(base), len(self.tokens))
        }
        self.shorter = [
            next((self.number[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.number), -1)
            for t in self.tokens
        ]
        self.automaton = ahocorasick.Automaton()
        self.longest_token = max(self.length)
        # For every path of the automaton from its root, the longest token on it.
        self.on_path: dict[str, int] = {}
        for i, token in sorted(enumerate(self.tokens), key=lambda pair: len(pair[1])):
            self.automaton.add_word(token, i)
            for n in range(len(token) - 1, 0, -1):
                if token[:n] in self.on_path:
                    break
                self.on_path[token[:n]] = self.shorter[i]
            self.on_path[token] = i
        self.automaton.make_automaton()
        # The pair-compatibility table, filled as pairs are met.
        self.fits: dict[tuple[int, int], bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` may stand side by side.

        Their merges are undone from the latest to the earliest; a merge across the border that
        is due before the one just undone would have been made instead.
        """
        due = len(self.tokens)
        while True:
            across = self.pairs.get((a, b))
            if across is not None and across < due:
                return False
            if max(a, b) < self.unmerged:
                return True
            if a > b:
                due, a = a, self.right[a]
            else:  # of equal merges the left one, which crosses the border, comes first
                due, b = b + 1, self.left[b]

    def encode(self, piece: str) -> list[int]:
        """Numbers of a piece's tokens; the piece is in the byte alphabet, with its END mark."""
        whole = self.number.get(piece)
        if whole is not None:
            return [whole]
        size, length, fits = len(piece), self.length, self.fits
        path, reach, on_path = self.automaton.longest_prefix, self.longest_token, self.on_path
        usable = bytearray(b"\x01") * (size + 1)
        if piece.endswith(END):
            usable[size - 1] = 0
        out: list[int] = []
        at, token = 0, on_path[piece[: path(piece[:reach])]]
        while True:
            end = at + length[token]
            good = usable[end]
            if good and out:
                pair = (out[-1], token)
                good = fits.get(pair)
                if good is None:
                    if len(fits) >= 4 * CACHE_CHUNKS:
                        fits.clear()
                    good = fits[pair] = self.compatible(*pair)
            if good:
                out.append(token)
                at = end
                if at == size:
                    return out
                token = on_path[piece[at : at + path(piece[at : at + reach])]]
            elif self.shorter[token] >= 0:
                token = self.shorter[token]
            else:
                usable[at] = 0
                token = out.pop()
                at -= length[token]


class WordBpe:
    """Encoder and decoder of a tokenizer file whose split pattern drops white space.

    Of the file: special tokens are found in the raw text; then Unicode composition and lower
    case, if named; then the pieces of the split pattern, in the byte alphabet. No piece spans
    white space, so a text is the sequence of its white-space separated chunks.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.pieces = PieceEncoder(model["vocab"], merges, self.suffix)
        steps = [step["type"] for step in _steps(spec["normalizer"], "normalizers")]
        self.compose, self.lower = "NFC" in steps, "Lowercase" in steps
        split = next(
            s for s in _steps(spec["pre_tokenizer"], "pretokenizers") if s["type"] == "Split"
        )
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ordered = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile(f"({'|'.join(map(regex.escape, ordered))})")
        self.letters = byte_letters()
        self.chunks = ChunkCache(self._encode_chunk)
        self.words = ChunkCache(self._encode_word)
        self.library = Tokenizer.from_file(path)
        self.token_bytes = [number.to_bytes(4, "little") for number in self.pieces.ids]
        self.id_bytes = {i: i.to_bytes(4, "little") for i in self.special.values()}
        self._offset_table(model["vocab"])

    def _encode_chunk(self, chunk: str) -> bytes:
        plain = self._normal(chunk)
        if plain.isalpha():
            return self.words[plain]
        if not any(mark in chunk for mark in self.special):
            return self._encode_part(chunk, plain)
        return b"".join(
            self.id_bytes[self.special[part]]
            if part in self.special
            else self._encode_part(part, self._normal(part))
            for part in self.special_pattern.split(chunk)
        )

    def _normal(self, part: str) -> str:
        if part.isascii():
            return part.lower() if self.lower else part
        if self.compose:
            part = unicodedata.normalize("NFC", part)
        # Letter by letter: a sigma at the end of a word is none of its own.
        return part.replace("\u03a3", "\u03c3").lower() if self.lower else part

    def _encode_part(self, part: str, plain: str) -> bytes:
        if unsure(part):
            # Letters younger than Python's tables, and separators that the tokenizers don't
            # take for space: the library's own first steps decide.
            split = self.library.pre_tokenizer.pre_tokenize_str
            pieces = [p for p, _ in split(self.library.normalizer.normalize_str(part))]
            return b"".join([self._encode_piece(piece) for piece in pieces])
        return b"".join(map(self.words.__getitem__, self.pattern.findall(plain)))

    def _encode_word(self, piece: str) -> bytes:
        letters = self.letters
        return self._encode_piece("".join([letters[byte] for byte in piece.encode()]))

    def _encode_piece(self, text: str) -> bytes:
        tokens = self.pieces.encode(text + END if self.suffix else text)
        token_bytes = self.token_bytes
        return b"".join([token_bytes[token] for token in tokens])

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a text."""
        chunks = SPACES.split(text) if SEPARATORS.search(text) else text.split()
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, chunks)), np.uint32)

    def _offset_table(self, vocab: dict[str, int]) -> None:
        """All tokens with a space behind, one after the other by id, and where each begins."""
        tokens = {number: token for token, number in {**vocab, **self.special}.items()}
        parts = [f"{tokens[i]} ".encode() if i in tokens else b"" for i in range(max(tokens) + 1)]
        self.buffer = np.frombuffer(b"".join(parts), np.uint8)
        self.sizes = np.array([len(part) for part in parts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the tokens, special ones too, separated by spaces: the file names no decoder."""
        sizes = self.sizes[ids]
        shift = self.starts[ids] - (np.cumsum(sizes) - sizes)
        places = np.arange(sizes.sum()) + np.repeat(shift, sizes)
        return self.buffer[places].tobytes()[:-1]


def _steps(part: dict | None, inner: str) -> list[dict]:
    if part is None:
        return []
    return part[inner] if part["type"] == "Sequence" else [part]


@lru_cache(maxsize=2)
def load_word_bpe(path: str) -> WordBpe:
    """The tokenizer of a file, once for each worker."""
    return WordBpe(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids array<int>, decoded string)`` for every row of ``docs``.

    ``path`` is a tokenizer file that every executor has. Texts are encoded whole; NULL text
    counts as empty and gives no ids. Equal texts give equal ids, rows may repeat, an empty
    table gives no rows. The only state of a worker is the file and a bounded cache.
    """

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_word_bpe(path)
        for batch in incoming:
            rows = zip(batch.column("doc_id"), batch.column("text"))
            sized = (((i, t), len(t.as_py())) for i, t in rows)
            for held in batches(sized, 4 << 20):
                encoded = [tokenizer.encode(text.as_py()) for _, text in held]
                ends = np.cumsum([0] + [len(ids) for ids in encoded]).astype(np.int32)
                values = np.concatenate(encoded).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i.as_py() for i, _ in held], batch.schema.field("doc_id").type),
                        pa.ListArray.from_arrays(ends, values),
                        pa.array([tokenizer.decode(ids) for ids in encoded]).cast(pa.string()),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
