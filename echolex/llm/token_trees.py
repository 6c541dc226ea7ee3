"""Edit-aware token counts: a segment tree of pre-tokens per document.

A byte-pair tokenizer encodes every pre-token by itself, so the tokens of a text
are the sum over its pre-tokens. They are held in segments of `SEGMENT`
pre-tokens, the leaves of a tree whose nodes sum up characters and tokens. An
edit finds its place by the character sums, splits into pre-tokens anew from a
little before it until a boundary falls on an old one behind it, encodes only
what came out, and updates the sums on the way to the root.

Splitting is a scan from left to right: what a match sees ends at most
`LOOKAHEAD` characters behind it, and what follows a boundary does not depend
on what is before. So pre-tokens that end that far before the edit stay, and
after the first common boundary all do.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

SEGMENT = 64
LOOKAHEAD = 2
CACHE_PIECES = 300_000  # pre-tokens whose count a worker keeps; it starts anew beyond
MAX_CACHED_CHARS = 64
PIECE_BATCH = 1_000_000  # characters handed on at once

EDITS = "array<struct<pos:long,remove:long,insert:string>>"
TREE = "struct<chars:array<int>,tokens:array<int>>"


class Counter:
    """Pre-tokens of a text and their token counts."""

    def __init__(self, ranks_path, pattern):
        import base64

        import regex
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern, self.known = regex.compile(pattern), {}

    def split(self, text):
        return self.pattern.findall(text)

    def matches(self, text, start):
        return self.pattern.finditer(text, start)

    def counts(self, pieces):
        if len(self.known) > CACHE_PIECES:
            self.known = {}
        found = list(map(self.known.get, pieces))
        if None in found:
            for i, n in enumerate(found):
                if n is None:
                    found[i] = self._count(pieces[i])
        return found

    def _count(self, piece):
        n = len(self.encoding.encode_ordinary(piece))
        if len(piece) <= MAX_CACHED_CHARS:
            self.known[piece] = n
        return n


@lru_cache(maxsize=2)
def counter(ranks_path, pattern):
    return Counter(ranks_path, pattern)


class TokenTree:
    """Segments of pre-tokens under a tree of character and token sums."""

    def __init__(self, chars, tokens):
        chars, tokens = np.asarray(chars, np.int64), np.asarray(tokens, np.int64)
        n = max(1, -(-len(chars) // SEGMENT))
        self.leaves = 1 << (n - 1).bit_length()
        cut = range(0, max(1, len(chars)), SEGMENT)
        self.segments = [(chars[c : c + SEGMENT].tolist(), tokens[c : c + SEGMENT].tolist()) for c in cut]
        self.segments += [([], []) for _ in range(self.leaves - len(self.segments))]
        self.chars = np.zeros(2 * self.leaves, np.int64)
        self.tokens = np.zeros(2 * self.leaves, np.int64)
        for i, (a, b) in enumerate(self.segments):
            self.chars[self.leaves + i], self.tokens[self.leaves + i] = sum(a), sum(b)
        for sums in (self.chars, self.tokens):
            level = self.leaves
            while level > 1:
                sums[level // 2 : level] = sums[level : 2 * level].reshape(-1, 2).sum(axis=1)
                level //= 2

    @property
    def n_tokens(self):
        return int(self.tokens[1])

    @property
    def n_chars(self):
        return int(self.chars[1])

    def find(self, pos):
        """(segment, pre-token in it, its start) of the pre-token that holds a character."""
        node, start = 1, 0
        while node < self.leaves:
            node *= 2
            if pos - start >= self.chars[node]:
                start += int(self.chars[node])
                node += 1
        segment, at = node - self.leaves, 0
        for size in self.segments[segment][0]:
            if pos - start < size:
                break
            start += size
            at += 1
        return segment, at, start

    def ends(self, segment, at, start):
        """(segment, number, end) of the pre-tokens from a place on."""
        while segment < self.leaves:
            sizes = self.segments[segment][0]
            while at < len(sizes):
                start += sizes[at]
                yield segment, at, start
                at += 1
            segment, at = segment + 1, 0

    def splice(self, first, last, chars, tokens):
        """Put new pre-tokens in place of those from `first` up to, not including, `last`."""
        (s, a), (e, b) = first, last
        tail = ([], []) if s == e else (self.segments[e][0][b:], self.segments[e][1][b:])
        old = self.segments[s]
        rest = (old[0][b:], old[1][b:]) if s == e else ([], [])
        self.segments[s] = (old[0][:a] + chars + rest[0], old[1][:a] + tokens + rest[1])
        for middle in range(s + 1, e):
            self.segments[middle] = ([], [])
        if s != e and e < self.leaves:
            self.segments[e] = tail
        for segment in range(s, min(e, self.leaves - 1) + 1):
            self._update(segment)

    def _update(self, segment):
        node = self.leaves + segment
        self.chars[node], self.tokens[node] = (sum(x) for x in self.segments[segment])
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def arrays(self):
        return [x for a, _ in self.segments for x in a], [x for _, b in self.segments for x in b]


def edit(tree, text, pos, remove, insert, count):
    """(new text, number of pre-tokens encoded) after one edit; the tree is updated."""
    pos = min(max(pos, 0), len(text))
    stop = min(pos + max(remove, 0), len(text))
    new = text[:pos] + insert + text[stop:]
    shift = len(new) - len(text)
    if not text:
        pieces = count.split(new)
        tree.splice((0, 0), (0, 0), [len(p) for p in pieces], count.counts(pieces))
        return new, len(pieces)
    # The first pre-token whose end, with what its match saw behind it, reaches the edit.
    segment, at, start = tree.find(min(max(pos - LOOKAHEAD, 0), len(text) - 1))
    if start > 0 and start > pos - LOOKAHEAD:
        segment, at, start = tree.find(start - 1)
    old = tree.ends(segment, at, start)
    place, old_end = (segment, at), start
    pieces, end, last = [], start, None
    matches = count.matches(new, start)
    while last is None:
        # Old boundaries behind the edit, moved by its change of length.
        while old_end < stop or old_end + shift < end:
            found = next(old, None)
            if found is None:
                last = (tree.leaves, 0)
                break
            place, old_end = (found[0], found[1] + 1), found[2]
        if last is None and old_end + shift == end and old_end >= stop and end >= pos + len(insert):
            last = place
            break
        match = next(matches, None)
        if match is None:
            last = last or (tree.leaves, 0)
            break
        last = None
        pieces.append(match.group())
        end = match.end()
    tree.splice((segment, at), last, [len(p) for p in pieces], count.counts(pieces))
    return new, len(pieces)


def build_trees(docs, ranks_path, pattern):
    """`docs` with a struct `tree`: characters and tokens of each pre-token.

    Needs text (string); a null text has no tree, an empty one a tree without
    pre-tokens. Repeated rows get equal trees; an empty table gives no rows.
    """
    if "tree" in docs.columns:
        raise ValueError("docs has a column named tree already")

    def run(batches):
        count = counter(ranks_path, pattern)
        for batch in batches:
            for part in _parts(batch):
                chars, tokens, sizes, there = [], [], [0], []
                for text in part["text"].to_pylist():
                    pieces = count.split(text or "")
                    chars.append(np.fromiter(map(len, pieces), np.int32, len(pieces)))
                    tokens.append(np.array(count.counts(pieces), np.int32))
                    sizes.append(sizes[-1] + len(pieces))
                    there.append(text is not None)
                yield _with_tree(part, np.concatenate(chars), np.concatenate(tokens), sizes, there)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, tree {TREE}")


def _parts(batch):
    """Slices of a batch with a bounded number of characters, by whole rows."""
    size = np.cumsum([0] + [len(t or "") for t in batch["text"].to_pylist()])
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(size, size[row] + PIECE_BATCH, "right")) - 1)
        yield batch.slice(row, end - row)
        row = end


def _with_tree(part, chars, tokens, sizes, there):
    bounds = pa.array(np.array(sizes, np.int32))
    lists = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (chars, tokens)]
    tree = pa.StructArray.from_arrays(lists, ["chars", "tokens"], mask=pa.array([not t for t in there]))
    return pa.RecordBatch.from_arrays([*part.columns, tree], names=[*part.schema.names, "tree"])


def apply_edits(trees, ranks_path, pattern):
    """`trees` after its column `edits`, with n_tokens and n_encoded.

    Columns text, tree and edits are needed; edits (pos, remove, insert, in
    characters) apply one after the other to the text as it then is. A place or
    length beyond the text is cut to it, a null one is 0, a null insertion is
    empty. A row with a null text keeps it and has 0 tokens. `edits` is dropped.
    n_encoded counts the pre-tokens that had to be encoded.
    """
    names = [c for c in trees.columns if c not in ("text", "tree", "edits")]

    def run(batches):
        count = counter(ranks_path, pattern)
        for batch in batches:
            for part in _parts(batch):
                texts, chars, tokens, sizes, there, total, encoded = [], [], [], [0], [], [], []
                edits = part["edits"].to_pylist()
                trees_, old = part["tree"], part["text"].to_pylist()
                for i, text in enumerate(old):
                    known = trees_[i]
                    there.append(text is not None)
                    n = 0
                    if text is None:
                        a, b, sum_ = [], [], 0
                    else:
                        tree = TokenTree(known["chars"].values.to_numpy(), known["tokens"].values.to_numpy())
                        for e in edits[i] or ():
                            text, m = edit(
                                tree, text, e["pos"] or 0, e["remove"] or 0, e["insert"] or "", count
                            )
                            n += m
                        (a, b), sum_ = tree.arrays(), tree.n_tokens
                    texts.append(text)
                    chars.append(np.array(a, np.int32))
                    tokens.append(np.array(b, np.int32))
                    sizes.append(sizes[-1] + len(a))
                    total.append(sum_)
                    encoded.append(n)
                rows = part.select([*names]).append_column("text", pa.array(texts, pa.string()))
                rows = _with_tree(rows, np.concatenate(chars), np.concatenate(tokens), sizes, there)
                rows = rows.append_column("n_tokens", pa.array(total, pa.int64()))
                yield rows.append_column("n_encoded", pa.array(encoded, pa.int64()))

    kept = ", ".join(f"`{n}` {trees.schema[n].dataType.simpleString()}, " for n in names).replace(", ,", ",")
    return trees.select(*[f"`{n}`" for n in names], "text", "tree", "edits").mapInArrow(
        run, f"{kept}text string, tree {TREE}, n_tokens long, n_encoded long"
    )


def tree_tokens(tree="tree"):
    """Tokens of a document from its tree; null has none."""
    return F.coalesce(F.aggregate(F.col(f"{tree}.tokens"), F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0).cast("long"))
