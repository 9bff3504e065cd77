"""Token counts that follow edits.

A document keeps a segment tree over its pre-tokens: a leaf stands for a run of them, and
every node holds how many characters and tokens lie under it. An edit finds its leaf by
the characters, re-encodes the pre-tokens from the leaf before it up to the first old leaf
end where the new pre-tokens meet the old ones again, and updates the sums above. Tokens
never cross pre-tokens, and pre-tokens are found from left to right with one character of
lookahead, so the count is that of the whole new text.
"""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pre-tokens of a new leaf.
_LEAF = 64
# Pre-tokens whose token counts a worker remembers.
_KNOWN = 300_000
_TREE = "leaves int, chars array<int>, tokens array<int>"


def build_token_trees(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, ``text`` and the tree of each document: ``leaves``, and ``chars`` and
    ``tokens`` of its nodes in heap order (node 1 is the root, the children of i are 2i
    and 2i + 1, node 0 is unused, the leaves are the last half).

    The tokenizer is a file of byte-pair ranks (each line a base64 token and its rank)
    and a pattern for pre-tokens that looks ahead by one character at most; the driver
    reads it. A null text is empty, with one empty leaf. The result may be stored and
    edited later.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rules = _rules(docs, ranks_path, pattern)
    schema = f"id {rows.schema['id'].dataType.simpleString()}, text string, {_TREE}"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(rules.value)
        for batch in batches:
            trees = [TokenTree.of(text, counter) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text"), *_tree_columns(trees)], ["id", "text", "leaves", "chars", "tokens"]
            )

    return rows.mapInArrow(build, schema)


def apply_edits(trees: DataFrame, ranks_path: str, pattern: str, edits_col: str = "edits") -> DataFrame:
    """The documents of :func:`build_token_trees` after their edits: ``id``, the new
    ``text`` and tree, ``tokens_before``, ``tokens_after``, ``pretokens_encoded`` (again)
    and ``leaves_touched``.

    ``edits_col`` is an array of ``(start, stop, insert)``: characters ``start`` up to
    ``stop`` of the old text, counted from 0, give way to ``insert`` (null: nothing).
    Edits may come in any order. Places beyond the end mean the end, and of edits at one
    place the first one's text comes first. An edit that begins inside what an earlier
    one replaces begins where that one stops, so no character is replaced twice. Null or no edits
    leave a document as it is. The edits of a document fit into its row, see
    :func:`gather_edits`.
    """
    rules = _rules(trees, ranks_path, pattern)
    rows = trees.select("id", "text", "leaves", "chars", "tokens", F.col(edits_col).alias("edits"))
    schema = (
        f"id {rows.schema['id'].dataType.simpleString()}, text string, {_TREE}, tokens_before long, tokens_after long, "
        "pretokens_encoded long, leaves_touched long"
    )

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(rules.value)
        for batch in batches:
            texts, edited, numbers = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("text", "leaves", "chars", "tokens", "edits"))
            for text, leaves, chars, tokens, edits in zip(*columns):
                tree = TokenTree(leaves, np.array(chars), np.array(tokens))
                before = int(tree.tokens[1])
                changes = [(e["start"], e["stop"], e["insert"] or "") for e in edits or [] if e is not None]
                texts.append(tree.edit(text, changes, counter))
                edited.append(tree)
                numbers.append((before, int(tree.tokens[1]), tree.encoded, tree.touched))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(texts, pa.string()),
                    *_tree_columns(edited),
                    *[pa.array([n[i] for n in numbers], pa.int64()) for i in range(4)],
                ],
                ["id", "text", "leaves", "chars", "tokens", "tokens_before", "tokens_after", "pretokens_encoded", "leaves_touched"],
            )

    return rows.mapInArrow(edit, schema)


def gather_edits(edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id`` and ``edits`` from a table with a row ``start``, ``stop``, ``insert`` for
    each edit. The edits of one document become one row, as its text is one."""
    change = F.struct(F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), "insert")
    return edits.groupBy(F.col(id_col).alias("id")).agg(F.array_sort(F.collect_list(change)).alias("edits"))


def _rules(df: DataFrame, ranks_path: str, pattern: str):
    with open(ranks_path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast((file.read(), pattern))


def _tree_columns(trees: list[TokenTree]) -> list[pa.Array]:
    kind = pa.list_(pa.int32())
    return [
        pa.array([t.leaves for t in trees], pa.int32()),
        pa.array([t.chars for t in trees], kind),
        pa.array([t.tokens for t in trees], kind),
    ]


class _Counter:
    """Pre-tokens and their token counts; what was met is shared by a worker's tasks."""

    def __init__(self, rules: tuple[bytes, str]):
        shared = sys.modules.setdefault("_deskline_token_counts", types.ModuleType("_deskline_token_counts"))
        if getattr(shared, "rules", None) != rules:
            import regex
            import tiktoken

            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rules[0].splitlines())}
            shared.encoding = tiktoken.Encoding("ranks", pat_str=rules[1], mergeable_ranks=ranks, special_tokens={})
            shared.split, shared.known, shared.rules = regex.compile(rules[1]).findall, {}, rules
        self.shared = shared

    def split(self, text: str) -> list[str]:
        return self.shared.split(text)

    def count(self, pretokens: list[str]) -> list[int]:
        known = self.shared.known
        try:
            return [known[p] for p in pretokens]
        except KeyError:
            if len(known) > _KNOWN:
                known.clear()
            fresh = {p: len(self.shared.encoding.encode_ordinary(p)) for p in {p for p in pretokens if p not in known}}
            known.update((p, n) for p, n in fresh.items() if len(p) <= 100)
            return [known[p] if p in known else fresh[p] for p in pretokens]


class TokenTree:
    def __init__(self, leaves: int, chars: np.ndarray, tokens: np.ndarray):
        self.leaves, self.chars, self.tokens = leaves, chars, tokens
        self.encoded = self.touched = 0

    @classmethod
    def of(cls, text: str, counter: _Counter) -> TokenTree:
        pretokens = counter.split(text)
        leaves = 1 << max(0, (max(len(pretokens), 1) - 1) // _LEAF).bit_length()
        tree = cls(leaves, np.zeros(2 * leaves, np.int64), np.zeros(2 * leaves, np.int64))
        tree._put(0, leaves, pretokens, counter)
        return tree

    def _put(self, first: int, end: int, pretokens: list[str], counter: _Counter) -> None:
        """Deal pre-tokens over the leaves from ``first`` on, and update the sums."""
        cuts = np.linspace(0, len(pretokens), end - first + 1).astype(int)
        values = np.zeros((2, len(pretokens) + 1), np.int64)
        np.cumsum([len(p) for p in pretokens], out=values[0, 1:])
        np.cumsum(counter.count(pretokens), out=values[1, 1:])
        low, high = self.leaves + first, self.leaves + end
        for nodes, sums in zip((self.chars, self.tokens), values):
            nodes[low:high] = np.diff(sums[cuts])
        while low > 1:
            low, high = low // 2, (high + 1) // 2
            for nodes in (self.chars, self.tokens):
                nodes[low:high] = nodes[2 * low : 2 * high : 2] + nodes[2 * low + 1 : 2 * high : 2]

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf begins; the last leaf with
        characters for the end of the text."""
        node, begin = 1, 0
        while node < self.leaves:
            node *= 2
            left = int(self.chars[node])
            if place >= begin + left and self.chars[node + 1]:
                begin, node = begin + left, node + 1
        return node - self.leaves, begin

    def edit(self, text: str, edits: list[tuple[int, int, str]], counter: _Counter) -> str:
        """The new text. The tree follows, edit by edit from left to right."""
        done, old = [], 0  # what is before the next edit, and how much of the old text it replaces
        length = 0
        for start, stop, insert in sorted(edits, key=lambda e: e[:2]):
            start, stop = (min(max(x, old), len(text)) for x in (start, max(start, stop)))
            place = length + start - old
            done += [text[old:start], insert]
            length, old = place + len(insert), stop
            if start < stop or insert:
                self._follow(done, length, text, place, stop, stop - start, counter)
        return "".join(done) + text[old:]

    def _follow(self, done: list[str], length: int, text: str, place: int, stop: int, removed: int, counter: _Counter) -> None:
        """Bring the tree up to date for one edit: at ``place`` of the text the tree is
        of, ``removed`` characters gave way to the end of ``done``, ``length`` characters
        in all. What follows is ``text`` from ``stop`` on."""
        first, begin = self._leaf_at(place)
        while first and begin >= place:  # the pre-token before may change
            first -= 1
            begin -= int(self.chars[self.leaves + first])
        last, end = self._leaf_at(place + removed)
        end += int(self.chars[self.leaves + last])
        before = _tail(done, length - begin)
        while True:
            kept = end - place - removed  # old characters behind the edit that are read
            context = text[stop + kept : stop + kept + 1]
            pretokens, at = [], 0
            region = before + text[stop : stop + kept]
            for p in counter.split(region + context):
                if at >= len(region):
                    break
                pretokens.append(p)
                at += len(p)
            # Met again: a pre-token ends where an old leaf ended.
            if at == len(region) or last + 1 == self.leaves:
                break
            last += 1
            end += int(self.chars[self.leaves + last])
        self._put(first, last + 1, pretokens, counter)
        self.encoded += len(pretokens)
        self.touched += last + 1 - first


def _tail(parts: list[str], size: int) -> str:
    """The last ``size`` characters of parts that follow each other."""
    found: list[str] = []
    for part in reversed(parts):
        if size <= 0:
            break
        found.append(part[-size:] if part else part)
        size -= len(part)
    return "".join(reversed(found))
