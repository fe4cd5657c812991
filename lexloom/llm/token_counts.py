"""Token counts by the whole-token shortcut.

Most pre-tokens of a text are strings of the vocabulary that encode alone as one token. Which
strings these are is proven once per worker before any text is read: a vocabulary string
counts if the merges, applied to it alone, end in that one token. Counting a text then looks
its pre-tokens up in that set and adds one for each; only the others are merged.
"""

from __future__ import annotations

import json

import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from lexloom.llm.batches import Chunks, blank_chunks, chunk_text, held, map_columns

# Fixed value: the pattern by which the byte-level pre-tokenizer splits text.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves, the others in turn for the characters
    from 256 on.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(256) if byte not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class Counter:
    """Counts the tokens of texts as the library does for one tokenizer file."""

    def __init__(self, content: str):
        described = json.loads(content)
        split = described["pre_tokenizer"] or {}
        plain = split.get("type") == "ByteLevel" and split["use_regex"]
        if described["normalizer"] or not plain or split["add_prefix_space"]:
            raise ValueError("only byte-level tokenizers without a normalizer or prefix blank")
        self._model = Tokenizer.from_str(content).model
        self._characters = byte_characters()
        added = [token["content"] for token in described["added_tokens"]]
        # Longer ones first, as one may begin with another.
        quoted = map(regex.escape, sorted(added, key=len, reverse=True))
        self._added = regex.compile("|".join(quoted)) if added else None
        self._findall = regex.compile(BYTE_LEVEL_PATTERN).findall
        self.whole = self._prove(described["model"]["vocab"])
        self._chunks = Chunks(blank_chunks(self._findall), self._solve)

    def _prove(self, vocabulary: dict[str, int]) -> frozenset[str]:
        """Strings of the vocabulary that are one pre-token and merge to one token."""
        to_byte = {c: b for b, c in self._characters.items()}
        proven = set()
        for token in vocabulary:
            if not all(c in to_byte for c in token):
                continue
            try:
                text = bytes(to_byte[c] for c in token).decode()
            except UnicodeDecodeError:
                continue  # part of a character: never a pre-token
            if self._findall(text) == [text] and len(self._model.tokenize(token)) == 1:
                proven.add(text)
        return frozenset(proven)

    def _merged(self, token: str) -> int:
        characters = self._characters
        return len(self._model.tokenize("".join([characters[b] for b in token.encode()])))

    def _solve(self, names: list[str]) -> list[int]:
        """Tokens of each chunk: proven pre-tokens are one each, the others are merged."""
        whole, cut = self.whole, [self._findall(chunk_text(name)) for name in names]
        rest = {token for chunk in cut for token in chunk if token not in whole}
        merged = {token: self._merged(token) for token in rest}
        return [sum([merged.get(token, 1) for token in chunk]) for chunk in cut]

    def __call__(self, texts: list[str]) -> list[int]:
        counts = self._chunks([self._without_added(t) for t in texts], sum)
        for i, text in enumerate(texts):
            if self._added is not None and self._added.search(text):
                parts = self._added.split(text)
                counts[i] = len(parts) - 1 + sum(self._chunks(parts, sum))
        return counts

    def _without_added(self, text: str) -> str:
        return "" if self._added is not None and self._added.search(text) else text


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int, text: str = "text", keep: tuple = ("doc_id",)
) -> DataFrame:
    """`keep`, n_bytes, n_tokens (long) and over_limit (more than `limit` tokens) per row.

    The tokenizer is a byte-level BPE in a .json file. Strings of its added tokens inside a
    text are one token each, as the library has it by default. A null text counts as empty.
    Repeated rows are each
    counted, very long texts as a whole; an empty table gives no rows. Other columns are not read.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())

    def make():
        # Held by the worker, so that the proof is made once.
        count = held(("counts", tokenizer_path), lambda: Counter(content.value))

        def work(texts):
            texts = [t or "" for t in texts]
            numbers = count(texts)
            return [len(t.encode()) for t in texts], numbers, [n > limit for n in numbers]

        return work

    outputs = "n_bytes bigint, n_tokens bigint, over_limit boolean"
    return map_columns(docs, make, [text], keep, outputs)
