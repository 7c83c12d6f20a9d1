"""Token counts that follow edits.

A text is cut into pre-tokens by a fixed pattern and each pre-token is encoded on its own, so a text's count
is the sum over its pre-tokens. A segment tree per document keeps, over runs of ``RUN`` pre-tokens, how many
characters and tokens they have. An edit touches few runs: only these, one run of context to the left and as
many characters to the right as it takes until a cut of the new text falls on a cut between old runs, are cut
and encoded again, into runs of the same size; then the sums above the touched leaves are updated. From a
common cut on, both texts are cut alike, because the pattern looks at what follows only. The tree is stored with
its inner sums. Runs stay short however many edits meet at one place and however long an insert is; only if
there are more runs than leaves for them are the leaves (numbers, no text) laid out anew.

Vocabulary file and pattern are parameters. Ranks are read once by the driver (a file of fixed size) and sent
to the tasks.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.frames import plus

# Fixed value: the public pre-token pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
RUN = 16
#: Characters behind a pre-token on which its end may depend.
AHEAD = 2
_MEMORY = 200_000


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Counter:
    """Tokens of pre-tokens, remembered for those seen lately."""

    def __init__(self, vocabulary: dict[bytes, int], pattern: str = PATTERN):
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={})
        self.memory: dict[str, int] = {}

    def count(self, token: str) -> int:
        found = self.memory.get(token)
        if found is None:
            if len(self.memory) >= _MEMORY:
                self.memory.clear()
            found = self.memory[token] = len(self.encoding.encode_ordinary(token))
        return found

    def runs(self, text: str) -> tuple[list[int], list[int], int]:
        """Characters and tokens of each run of a text, and the number of pre-tokens."""
        tokens = self.pattern.findall(text)
        memory, count = self.memory, self.count
        counts = [memory[t] if t in memory else count(t) for t in tokens]
        chars = [sum(map(len, tokens[i : i + RUN])) for i in range(0, len(tokens), RUN)]
        return chars, [sum(counts[i : i + RUN]) for i in range(0, len(tokens), RUN)], len(tokens)


class Tree:
    """Sums of characters and tokens over a document's runs, in an implicit binary tree."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.leaves = 1 << max(0, (len(chars) - 1).bit_length())
        self.chars, self.tokens = [0] * (2 * self.leaves), [0] * (2 * self.leaves)
        self.chars[self.leaves : self.leaves + len(chars)] = chars
        self.tokens[self.leaves : self.leaves + len(tokens)] = tokens
        for node in range(self.leaves - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it begins; the last leaf for the end."""
        node, begin = 1, 0
        while node < self.leaves:
            node *= 2
            if char >= begin + self.chars[node] and self.chars[node + 1]:
                begin += self.chars[node]
                node += 1
        return node - self.leaves, begin

    def replace(self, first: int, last: int, chars: list[int], tokens: list[int]) -> None:
        """Put runs in place of those that leaves ``first`` to ``last`` - 1 hold, and update sums."""
        if len(chars) > last - first:
            before, after = slice(self.leaves, self.leaves + first), slice(self.leaves + last, 2 * self.leaves)
            kept = [
                (c, t)
                for c, t in zip(
                    [*self.chars[before], *chars, *self.chars[after]],
                    [*self.tokens[before], *tokens, *self.tokens[after]],
                    strict=True,
                )
                if c
            ]
            self.__init__([c for c, _ in kept], [t for _, t in kept])
            return
        for leaf in range(first, last):
            node, nth = self.leaves + leaf, leaf - first
            held = nth < len(chars)
            self.chars[node], self.tokens[node] = (chars[nth], tokens[nth]) if held else (0, 0)
        nodes = {(self.leaves + leaf) // 2 for leaf in range(first, last)}
        while nodes:
            for node in nodes - {0}:
                self._sum(node)
            nodes = {node // 2 for node in nodes if node > 1}

    def pack(self) -> bytes:
        """All sums, inner ones too."""
        return np.array([self.chars, self.tokens], dtype=np.int64).tobytes()

    @classmethod
    def unpack(cls, packed: bytes | None) -> Tree:
        if not packed:
            return cls([], [])
        tree = cls.__new__(cls)
        tree.chars, tree.tokens = np.frombuffer(packed, np.int64).reshape(2, -1).tolist()
        tree.leaves = len(tree.chars) // 2
        return tree


def edit(tree: Tree, counter: Counter, text: str, start: int, length: int, insert: str) -> tuple[str, int]:
    """Apply one edit to a text and its tree; return the new text and the characters encoded again.

    Places beyond the text are moved to its end.
    """
    start = min(max(0, start), len(text))
    stop = min(len(text), start + max(0, length))
    new = text[:start] + insert + text[stop:]
    first, begin = tree.leaf_at(max(0, start - AHEAD))
    last, shift = first, len(new) - len(text)
    old_end = begin
    at, chars, tokens = begin, [], []
    for nth, match in enumerate(counter.pattern.finditer(new, begin)):
        at = match.end()
        if nth % RUN == 0:
            chars.append(0)
            tokens.append(0)
        chars[-1] += at - match.start()
        tokens[-1] += counter.count(match.group())
        # Take in old runs up to this cut; stop if the cut is also theirs and the edit is behind.
        while last < tree.leaves and old_end + shift < at or old_end < stop and last < tree.leaves:
            old_end += tree.chars[tree.leaves + last]
            last += 1
        if old_end >= stop and old_end + shift == at:
            break
    else:
        last, at = tree.leaves, len(new)
    tree.replace(first, max(last, first + 1), chars, tokens)
    return new, at - begin


def _counter(spark: SparkSession, vocabulary: str, pattern: str) -> Callable[[], Counter]:
    shared = spark.sparkContext.broadcast(ranks(vocabulary))
    return lambda: Counter(shared.value, pattern)


def counted(
    docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN
) -> DataFrame:
    """All rows and columns, plus ``n_pretokens``, ``n_tokens`` and ``token_tree`` (all sums of the tree).

    NULL and empty texts have no tokens. Repeated rows get equal results. Columns of these names are replaced.
    """
    rows = docs.drop(*[c for c in docs.columns if c.lower() in ("n_pretokens", "n_tokens", "token_tree")])
    make = _counter(docs.sparkSession, vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = make()
        for batch in batches:
            found = [counter.runs(t.as_py() or "") for t in batch.column(text_col)]
            more = [
                pa.array([n for _, _, n in found], pa.int64()),
                pa.array([sum(tokens) for _, tokens, _ in found], pa.int64()),
                pa.array([Tree(chars, tokens).pack() for chars, tokens, _ in found], pa.binary()),
            ]
            names = [*batch.schema.names, "n_pretokens", "n_tokens", "token_tree"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=names)

    return rows.mapInArrow(run, plus(rows.schema, None, "n_pretokens long, n_tokens long, token_tree binary"))


def recounted(
    rows: DataFrame,
    edits_col: str = "edits",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
    keep_text: bool = True,
) -> DataFrame:
    """Rows of ``counted`` after their edits, an array of (start, length, insert) applied in turn.

    Text and tree are the new ones; ``n_tokens`` stays the count before, ``edited_tokens`` is the one after,
    ``encoded_chars`` how many characters were encoded for it. NULL for edits means none, NULL inside an edit
    0 or nothing, NULL for the text the empty text.
    """
    made = ("edited_tokens", "edited_chars", "encoded_chars")
    rows = rows.drop(*[c for c in rows.columns if c.lower() in made])
    make = _counter(rows.sparkSession, vocabulary, pattern)
    left_out = () if keep_text else (text_col, "token_tree", edits_col)
    schema = rows.drop(*left_out).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = make()
        for batch in batches:
            texts, trees, totals, lengths, encoded = [], [], [], [], []
            packed, edits = batch.column("token_tree"), batch.column(edits_col)
            for row, value in enumerate(batch.column(text_col)):
                text, tree, work = value.as_py() or "", Tree.unpack(packed[row].as_py()), 0
                for step in edits[row].as_py() or ():
                    text, chars = edit(tree, counter, text, step["start"] or 0, step["length"] or 0, step["insert"] or "")
                    work += chars
                    if not tree.length:
                        tree = Tree([], [])
                texts.append(text)
                trees.append(tree.pack())
                totals.append(tree.total)
                lengths.append(len(text))
                encoded.append(work)
            new = {text_col: pa.array(texts, pa.string()), "token_tree": pa.array(trees, pa.binary())}
            names = [c for c in batch.schema.names if c not in left_out]
            columns = [new.get(c, batch.column(c)) for c in names]
            columns += [pa.array(c, pa.int64()) for c in (totals, lengths, encoded)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *("edited_tokens", "edited_chars", "encoded_chars")])

    return rows.mapInArrow(run, plus(schema, None, "edited_tokens long, edited_chars long, encoded_chars long"))
