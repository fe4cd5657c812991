"""Finding secrets in text with a trigram index.

For each rule's regular expression a Boolean query over trigrams is derived, which every text
with a match satisfies. The texts of a batch are indexed: one posting list, as a bitmap over
the batch's texts, for each trigram that any query names. A rule's query intersects and unites
posting lists, and the expression itself is run on the texts that remain. A rule from which no
trigram follows is run on all texts. The index covers lower-case ASCII letters, so one index
serves rules of either kind. An index per batch needs no shuffle and is gone with its batch.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import product
from re import _constants as op
from re import _parser as parser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.batches import map_columns, quoted

# Sets of alternatives beyond this size are not followed further; the query gets weaker.
MOST_ALTERNATIVES = 64
MOST_CHARACTERS = 8
# Texts indexed together.
TEXTS_AT_ONCE = 500
# Never part of UTF-8: no trigram reaches from one text into the next.
BORDER = b"\xff\xff"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: the matches of `pattern` whose group `group` is long enough."""

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 0


# The base rules, in the order of their kinds. The lengths that the second and
# third need stand in the pattern: a match is a whole run of its characters, and no shorter
# run holds a longer match.
BASE_RULES = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        min_length=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Forms of tokens that their issuers document.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abpr]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES

# A query is True (no condition), a trigram, or ("and" | "or", queries).


def _all(queries) -> object:
    queries = [q for q in queries if q is not True]
    if len(queries) < 2:
        return queries[0] if queries else True
    return ("and", queries)


def _any(queries) -> object:
    queries = list(queries)
    if True in queries:
        return True
    return queries[0] if len(queries) == 1 else ("or", queries)


def _of_strings(strings: set[str]) -> object:
    """One of the strings occurs."""
    options = []
    for string in sorted(strings):
        raw = string.encode()
        grams = dict.fromkeys(raw[i : i + 3] for i in range(len(raw) - 2))
        options.append(_all(grams))
    return _any(options)


def _characters(items) -> set[str] | None:
    """The characters of a class, lower-case; None if it is negated or large."""
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < MOST_ALTERNATIVES:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= MOST_CHARACTERS else None


def _analyse(nodes) -> tuple[set[str] | None, object]:
    """(all texts the nodes match if they are few, else None; a query every match satisfies)."""
    conditions: list[object] = []
    strings, exact = {""}, True

    def flush() -> None:
        nonlocal strings, exact
        conditions.append(_of_strings(strings))
        strings, exact = {""}, False

    for kind, value in nodes:
        options: set[str] | None = None
        inner: object = True
        repeats = False
        if kind is op.LITERAL:
            options = {chr(value).lower()}
        elif kind is op.IN:
            options = _characters(value)
        elif kind is op.AT:
            continue
        elif kind is op.SUBPATTERN:
            options, inner = _analyse(value[3])
        elif kind is op.BRANCH:
            branches = [_analyse(branch) for branch in value[1]]
            if all(strings_ is not None for strings_, _ in branches):
                options = set().union(*[strings_ for strings_, _ in branches])
            inner = _any(query for _, query in branches)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            least, most, body = value
            once, query = _analyse(body)
            if least == 0:
                options = {""} | once if most == 1 and once is not None else None
            else:
                options, inner = once, query
                repeats = (least, most) != (1, 1)
        if options is None or len(options) * len(strings) > MOST_ALTERNATIVES:
            flush()
            conditions.append(inner)
            if options is None or len(options) > MOST_ALTERNATIVES:
                continue
        strings = {a + b for a, b in product(strings, options)}
        if repeats:
            flush()  # what follows does not stand right behind the first time
    if exact:
        return strings, _of_strings(strings)
    flush()
    return None, _all(conditions)


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query of a pattern; True if none follows from it."""
    return _analyse(parser.parse(pattern))[1]


def _grams(query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_grams, query[1]))


class Finder:
    """Finds the spans of all rules in batches of texts."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = rules
        self.queries = [trigram_query(rule.pattern) for rule in rules]
        self._compiled = [re.compile(rule.pattern, re.ASCII) for rule in rules]
        grams = sorted(set().union(*map(_grams, self.queries)))
        self._number = {gram: i for i, gram in enumerate(grams)}
        # For each of the 2 ** 24 trigrams its number here, from 1.
        self._numbers = np.zeros(1 << 24, np.uint16)
        for gram, i in self._number.items():
            self._numbers[int.from_bytes(gram, "big")] = i + 1

    def postings(self, texts: list[str]) -> np.ndarray:
        """A row per trigram, with a bit for each text that has it."""
        raw = [text.encode().lower() for text in texts]
        found = np.zeros((len(self._number), len(texts)), bool)
        if not self._number:
            return found
        stops = np.cumsum([len(r) + len(BORDER) for r in raw])
        codes = np.frombuffer(BORDER.join([*raw, b""]), np.uint8).astype(np.int32)
        codes = (codes[:-2] << 16) | (codes[1:-1] << 8) | codes[2:]
        numbers = self._numbers[codes]
        at = np.flatnonzero(numbers)
        found[numbers[at] - 1, np.searchsorted(stops, at, side="right")] = True
        return found

    def _select(self, query, postings: np.ndarray) -> np.ndarray:
        if isinstance(query, bytes):
            return postings[self._number[query]]
        kind, parts = query
        join = np.logical_and if kind == "and" else np.logical_or
        return join.reduce([self._select(part, postings) for part in parts])

    def candidates(self, texts: list[str]) -> list[Sequence[int]]:
        """For each rule the texts that its query leaves; all where it has none."""
        postings = self.postings(texts)
        return [
            range(len(texts)) if q is True else np.flatnonzero(self._select(q, postings)).tolist()
            for q in self.queries
        ]

    def __call__(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """(kind, start, end) in code points of each text, by start, then rule."""
        spans: list[list] = [[] for _ in texts]
        for start in range(0, len(texts), TEXTS_AT_ONCE):
            part = texts[start : start + TEXTS_AT_ONCE]
            for number, rows in enumerate(self.candidates(part)):
                rule, finditer = self.rules[number], self._compiled[number].finditer
                for row in rows:
                    for match in finditer(part[row]):
                        if len(match[rule.group]) >= rule.min_length:
                            spans[start + row].append((match.start(), number, match.end()))
        kinds = [rule.kind for rule in self.rules]
        return [[(kinds[n], a, b) for a, n, b in sorted(found)] for found in spans]


@lru_cache(maxsize=4)
def _finder(rules: tuple[Rule, ...]) -> Finder:
    return Finder(rules)


def find_secrets(
    docs: DataFrame, rules: tuple = RULES, text: str = "text", keep: tuple = ("doc_id",)
) -> DataFrame:
    """`keep` and spans (array of kind, start, end): leftmost non-overlapping per kind.

    Starts and ends count code points, the end is not included. Spans are ordered by start,
    then by the order of the rules. A null or empty text has no spans. Repeated rows are each
    searched. Other columns are not read.
    """

    def make():
        find = _finder(rules)

        def work(texts):
            found = find([t or "" for t in texts])
            names = ("kind", "start", "end")
            return ([[dict(zip(names, span)) for span in spans] for spans in found],)

        return work

    outputs = "spans array<struct<kind: string, start: bigint, end: bigint>>"
    return map_columns(docs, make, [text], keep, outputs)


def spans_text(spans) -> object:
    """kind:start:end of each span, comma-joined."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(parts, ",")


def redact(
    docs: DataFrame, rules: tuple = RULES, text: str = "text", mark: str = "[secret]"
) -> DataFrame:
    """The rows with each secret in `text` replaced by `mark`; overlapping spans by one.

    Null and empty texts stay as they are, as does every other column.
    """

    def make():
        find = _finder(rules)

        def work(texts):
            spans = find([t or "" for t in texts])
            return ([_replaced(t, s, mark) if s else t for t, s in zip(texts, spans)],)

        return work

    others = [c for c in docs.columns if c != text]
    made = map_columns(docs, make, [text], others, f"{quoted(text)} string")
    return made.select(*[F.col(quoted(c)) for c in docs.columns])


def _replaced(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    parts, done = [], 0
    for _, start, end in spans:
        if start >= done:
            parts += [text[done:start], mark]
        done = max(done, end)
    return "".join([*parts, text[done:]])
