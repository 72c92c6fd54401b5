"""BPE encoding and decoding (operator 1).

Method: the distinct unseen words of a slice of a partition are laid out as one
chain of symbols; a *pair occurrence index* maps the rank of each adjacent pair
to all its positions; the active ranks are applied in ascending order, each to
all its positions from left to right, and the lists of the pairs that a merge
creates are extended.  Words seen before come from a bounded memory.

The tokenizer is a JSON file of the public tokenizers library (BPE with an
end-of-word suffix, byte-level alphabet, no decoder); it is shipped once per
executor as a broadcast of fixed size, not read from a path on the executors.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata

import regex
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import map_rows, resident, table

MEMORY_WORDS = 200_000  # distinct words remembered by a Python worker

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def tokenizer_path() -> str:
    """The vocabulary file's place; a parameter of every function here."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte value: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in out:
            out[b], spare = chr(spare), spare + 1
    return [out[b] for b in range(256)]


class PairIndexBpe:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(merges)}
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.last = [vocab[c + suffix] for c in alphabet]
        (split,) = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        # \s of the file is Unicode White_Space, which \s of Python's regex also is
        self.words = regex.compile(split["pattern"]["Regex"]).findall
        # code points that Python's Unicode tables may not know yet: the library itself cuts such texts
        self.newer = regex.compile("[\u0558-\U0010ffff]").search
        self.library_split = tokenizers.pre_tokenizers.Split(tokenizers.Regex(split["pattern"]["Regex"]), "removed", invert=True).pre_tokenize_str
        # the normaliser alone: the library's own vocabulary and merges would be held beside ours
        bare = {**spec, "added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}}
        self.library_norm = tokenizers.Tokenizer.from_str(json.dumps(bare)).normalizer.normalize_str
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split
        self.written = {str(i): t for i, t in self.tokens.items()}.__getitem__
        self.memory: dict[str, str] = {}  # word -> its ids as text, and no more: an executor holds several workers' memories

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, all words together through the pair occurrence index."""
        sym: list[int] = []
        starts = []
        for w in words:
            raw = w.encode("utf-8", "surrogatepass")
            starts.append(len(sym))
            sym.extend([self.inner[b] for b in raw[:-1]])
            sym.append(self.last[raw[-1]])
            sym.append(-1)  # between words; in no pair
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank.get
        index: dict[int, list[int]] = {}
        product: dict[int, tuple[int, int, int]] = {}
        for i in range(n - 1):
            pair = (sym[i], sym[i + 1])
            hit = rank(pair)
            if hit:
                r = hit[0]
                if r in index:
                    index[r].append(i)
                else:
                    index[r] = [i]
                    product[r] = (*pair, hit[1])
        active = list(index)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            places = index.pop(r)
            a, b, ab = product[r]
            places.sort()
            for i in places:
                if sym[i] != a:
                    continue
                j = nxt[i]
                if j >= n or sym[j] != b:
                    continue
                k = nxt[j]
                sym[i], sym[j] = ab, -2  # j is gone
                nxt[i] = k
                if k < n:
                    prv[k] = i
                for left, right in ((prv[i], i), (i, k)):
                    if left < 0 or right >= n:
                        continue
                    pair = (sym[left], sym[right])
                    hit = rank(pair)
                    if hit:
                        q = hit[0]
                        if q in index:
                            index[q].append(left)
                        else:
                            index[q] = [left]
                            product[q] = (*pair, hit[1])
                            heapq.heappush(active, q)
        out = []
        for s in starts:
            ids, i = [], s
            while sym[i] != -1:
                ids.append(sym[i])
                i = nxt[i]
            out.append(ids)
        return out

    def pre_tokens(self, text: str | None) -> list[str]:
        """Words of the normalised text (NFC, lower case by character); special tokens stay as they are."""
        if not text:
            return []
        if "<|" not in text:
            return self._plain(text)
        out = []
        for k, part in enumerate(self.split_special(text)):
            out += [part] if k % 2 else self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        if self.newer(text):
            return [w for w, _ in self.library_split(self.library_norm(text))]
        t = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # no final-sigma rule: each character by itself
        return self.words(t)

    def learn(self, words: set[str]) -> None:
        """Put the words that are not remembered yet through the index."""
        new = [w for w in words if w not in self.memory]
        if not new:
            return
        if len(self.memory) + len(new) > MEMORY_WORDS:
            self.memory.clear()
            new = list(words)
        plain = [w for w in new if w not in self.special]
        for w, ids in zip(plain, self.encode_words(plain), strict=True):
            self.memory[w] = " ".join(map(str, ids))
        for w in new:
            if w in self.special:
                self.memory[w] = str(self.special[w])

    def encode(self, text: str | None) -> list[int]:
        words = self.pre_tokens(text)
        self.learn(set(words))
        return [int(i) for w in words for i in self.memory[w].split(" ")]

    def decode(self, ids: list[int]) -> str:
        """The file has no decoder: tokens joined by one space, ids outside the vocabulary left out."""
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])


def _digests(bpe: PairIndexBpe, texts: list[str | None]):
    for at in range(0, len(texts), 64):
        split = [bpe.pre_tokens(t) for t in texts[at : at + 64]]
        bpe.learn(set().union(*split))
        for words in split:
            ids = " ".join([bpe.memory[w] for w in words])
            each = ids.split(" ") if ids else []
            decoded = " ".join(map(bpe.written, each))
            yield (
                len(each),
                hashlib.sha256(ids.encode()).hexdigest(),
                hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest(),
            )


def _worker_bpe(spec: str) -> PairIndexBpe:
    """One encoder, with its memory, per Python worker and vocabulary."""
    return resident(("bpe", hash(spec)), lambda: PairIndexBpe(json.loads(spec)))


def _spec(spark: SparkSession, path: str | None):
    with open(path or tokenizer_path(), encoding="utf-8") as f:  # a file of the driver's own installation
        return spark.sparkContext.broadcast(f.read())


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Digests of the ids and of the decoded text of each row's whole ``text``.

    A null or empty text has no tokens (n_tokens 0, digests of the empty
    string).  Repeated rows and null doc_ids give one row each; other columns
    are not read.  No shuffle."""
    spec = _spec(docs.sparkSession, path)

    def run(slices):
        bpe = _worker_bpe(spec.value)
        for c in slices:
            n, ids, decoded = zip(*_digests(bpe, c["text"]), strict=True)
            yield {"doc_id": c["doc_id"], "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), run, SCHEMA)


def encode_ids(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the ids themselves (array of int), for training files."""
    spec = _spec(docs.sparkSession, path)

    def run(slices):
        bpe = _worker_bpe(spec.value)
        for c in slices:
            yield {"doc_id": c["doc_id"], "ids": [bpe.encode(t) for t in c["text"]]}

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the decoded text of an ``ids`` column (null ids: empty text)."""
    spec = _spec(encoded.sparkSession, path)

    def run(slices):
        bpe = _worker_bpe(spec.value)
        for c in slices:
            yield {"doc_id": c["doc_id"], "text": [bpe.decode(i or []) for i in c["ids"]]}

    return map_rows(encoded.select(F.col("doc_id").cast("long"), "ids"), run, "doc_id long, text string")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
