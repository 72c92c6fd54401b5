"""Token counts under edits (operator 3).

Method: a document's pre-tokens lie in blocks of at most BLOCK; a segment tree
over the blocks holds sums of characters and of tokens.  An edit descends the
tree to the block of its place, goes back to a pre-token boundary that the edit
cannot move (CONTEXT characters before it), cuts the changed text into
pre-tokens from there until a boundary falls on an old one behind the edit,
counts the tokens of those pre-tokens only, and updates the sums on the path to
the root.  The count of the whole document is the root's.

The tokenizer is a rank file of the public tokenizers (byte-level BPE), given
as a path; it is read on the driver and sent as a broadcast of fixed size.
"""

from __future__ import annotations

import base64
from bisect import bisect_right

import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import map_rows, resident, table

BLOCK = 64
CONTEXT = 4  # no match of the pattern looks further ahead than this
EDIT_EVERY = 2000  # characters; the query edits each document once in so many
MEMORY_CHARS = 2_500_000

SCHEMA = "doc_id long, n_tokens_before long, n_tokens long, n_edits long, n_pre_tokens long, n_recounted long"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Counts(dict):
    """Pre-token -> number of tokens, remembered; forgets everything past MEMORY_CHARS characters."""

    def __init__(self, ranks: bytes, split: str):
        super().__init__()
        table_ = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=split, mergeable_ranks=table_, special_tokens={})
        self.split = regex.compile(split)
        self.chars = 0

    def __missing__(self, piece: str) -> int:
        self.chars += len(piece)
        if self.chars > MEMORY_CHARS:
            self.clear()
            self.chars = len(piece)
        n = len(self.encoding.encode_ordinary(piece))
        self[piece] = n
        return n


class DocumentTree:
    """Blocks of pre-tokens of one text under a segment tree of sums."""

    def __init__(self, text: str, counts: Counts):
        self.text, self.counts = text, counts
        pieces = counts.split.findall(text)
        sizes = list(map(len, pieces))
        tokens = list(map(counts.__getitem__, pieces))
        self._build([sizes[i : i + BLOCK] for i in range(0, len(sizes), BLOCK)] or [[]], [tokens[i : i + BLOCK] for i in range(0, len(tokens), BLOCK)] or [[]])
        self.recounted = 0

    def _build(self, sizes: list[list[int]], tokens: list[list[int]]) -> None:
        self.sizes, self.tokens = sizes, tokens
        self.width = 1 << (len(sizes) - 1).bit_length()
        pad = self.width - len(sizes)
        self.chars = [0] * self.width + [sum(b) for b in sizes] + [0] * pad
        self.sums = [0] * self.width + [sum(b) for b in tokens] + [0] * pad
        for i in range(self.width - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.sums[1]

    @property
    def n_pre_tokens(self) -> int:
        return sum(map(len, self.sizes))

    def find(self, place: int) -> tuple[int, int]:
        """The block that holds the character at ``place`` (the last block at the end), and the block's first character."""
        i, start = 1, 0
        while i < self.width:
            i *= 2
            if place >= start + self.chars[i] and self.chars[i + 1]:
                start += self.chars[i]
                i += 1
        return i - self.width, start

    def _update(self, block: int) -> None:
        i = block + self.width
        self.chars[i], self.sums[i] = sum(self.sizes[block]), sum(self.tokens[block])
        i //= 2
        while i:
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]
            i //= 2

    def edit(self, place: int, removed: int, inserted: str) -> None:
        """Replace ``removed`` characters at ``place`` (both cut to the text) by ``inserted``."""
        place = min(max(place, 0), len(self.text))
        removed = min(max(removed, 0), len(self.text) - place)
        if not removed and not inserted:
            return
        text = self.text[:place] + inserted + self.text[place + removed :]
        grown = len(inserted) - removed
        # the last boundary that is at least CONTEXT before the edit
        first, start = self.find(max(place - CONTEXT, 0))
        ends = [start]
        for s in self.sizes[first]:
            ends.append(ends[-1] + s)
        keep = max(bisect_right(ends, place - CONTEXT) - 1, 0)
        at = ends[keep]
        # old boundaries behind the edit, block by block, until a new one falls on one of them
        last, old_end, behind = first, ends[-1], {e: (first, k) for k, e in enumerate(ends) if e >= place + removed}
        new_sizes, new_tokens = [], []
        stop = None
        matches = self.counts.split.finditer(text, at)
        while stop is None:
            stop = behind.get(at - grown) if at >= place + len(inserted) else None
            if stop is not None:
                break
            while at - grown >= old_end and last + 1 < len(self.sizes):
                last += 1
                for k, s in enumerate(self.sizes[last]):
                    old_end += s
                    if old_end >= place + removed:
                        behind[old_end] = (last, k + 1)
                if at >= place + len(inserted) and at - grown in behind:
                    stop = behind[at - grown]
                    break
            if stop is not None:
                break
            m = next(matches, None)
            if m is None:  # the end of the text
                stop = (len(self.sizes) - 1, len(self.sizes[-1]))
                break
            new_sizes.append(m.end() - m.start())
            new_tokens.append(self.counts[m.group()])
            at = m.end()
        block, k = stop
        sizes = self.sizes[first][:keep] + new_sizes + self.sizes[block][k:]
        tokens = self.tokens[first][:keep] + new_tokens + self.tokens[block][k:]
        self.text = text
        self.recounted += len(new_sizes)
        if len(sizes) > 4 * BLOCK:  # a long insertion: split the block, build the tree anew
            cut = range(0, len(sizes), BLOCK)
            self._build(
                self.sizes[:first] + [sizes[i : i + BLOCK] for i in cut] + self.sizes[block + 1 :],
                self.tokens[:first] + [tokens[i : i + BLOCK] for i in cut] + self.tokens[block + 1 :],
            )
            return
        self.sizes[first], self.tokens[first] = sizes, tokens
        for b in range(first + 1, block + 1):
            self.sizes[b], self.tokens[b] = [], []
            self._update(b)
        self._update(first)


def _worker_counts(spec: tuple[bytes, str]) -> Counts:
    return resident(("counts", hash(spec)), lambda: Counts(*spec))


def count_edited(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Token counts of each row's whole text before and after its edits.

    ``docs`` has doc_id, text and edits, an array of (place, removed, inserted)
    in characters (code points) of the text; they are applied from the last place to the
    first (equal places: from the last in the array), so that places refer to the text
    as it was.  Null text: an empty one.  Null edits: none; null fields: 0 and ''.
    Places outside the text are moved to its ends.  n_recounted is the number of
    pre-tokens that were cut and counted again.  Other columns are not read."""
    with open(path or tokenizer_path(), "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast((f.read(), pattern()))

    def run(slices):
        counts = _worker_counts(spec.value)
        for c in slices:
            out = {k: [] for k in ("n_tokens_before", "n_tokens", "n_edits", "n_pre_tokens", "n_recounted")}
            for text, edits in zip(c["text"], c["edits"], strict=True):
                tree = DocumentTree(text or "", counts)
                out["n_tokens_before"].append(tree.n_tokens)
                todo = sorted(((e["place"] or 0, k, e) for k, e in enumerate(edits or []) if e), key=lambda x: x[:2], reverse=True)
                for place, _, e in todo:
                    tree.edit(place, e["removed"] or 0, e["inserted"] or "")
                out["n_tokens"].append(tree.n_tokens)
                out["n_edits"].append(len(todo))
                out["n_pre_tokens"].append(tree.n_pre_tokens)
                out["n_recounted"].append(tree.recounted)
            yield {"doc_id": c["doc_id"], **out}

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text", "edits"), run, SCHEMA)


def derived_edits(docs: DataFrame, every: int = EDIT_EVERY) -> DataFrame:
    """``docs`` with edits made from the documents themselves: one in each ``every`` characters, which
    replaces up to 40 characters by up to 30 of the document's first ones, at places drawn by a hash."""
    def one(k):
        h = F.crc32(F.concat_ws(":", F.col("doc_id").cast("string"), k.cast("string")).cast("binary"))
        return F.struct(
            (k * every + h % every).cast("long").alias("place"),
            (F.shiftright(h, 8) % 41).cast("long").alias("removed"),
            F.substr(F.col("text"), F.lit(1), (F.shiftright(h, 16) % 31).cast("int")).alias("inserted"),
        )

    n = F.ceil(F.length("text") / every).cast("int")
    return docs.withColumn("edits", F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one)))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_edited(derived_edits(docs))
