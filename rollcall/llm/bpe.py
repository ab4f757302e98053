"""BPE encoding and decoding: speculate by longest match, verify every adjacent pair.

A text is split as the tokenizer file says: its special strings first, then
NFC, lower case and the word pattern. A word type is encoded once per worker:

1. a trie walk over all new words at once proposes, left to right, the longest
   token at each place;
2. every adjacent pair of proposed tokens is tested for compatibility: would
   merging the two tokens' bytes alone ever have joined symbols across their
   border? The test runs on arrays of distinct pairs, going back in merge
   order along the facing edges of both tokens. A proposal all of whose pairs
   are compatible is the exact encoding, as the earliest merge across any
   border would also have happened in that pair alone;
3. words with an incompatible pair are merged exactly, pair by pair.

Decoding follows the file too: it has no decoder, so tokens are joined by a
blank, word ends included.

Defined cases: a null or empty text has no tokens and decodes to the empty
text; rows with equal ids stay separate; an empty table gives an empty result;
extra columns are ignored. Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rollcall.llm.store import pick, release, releasing, ship_code

WORD_END = "</w>"
KNOWN_WORDS = 100_000         # word types that a worker remembers before it starts anew
SLICE_CHARS = 250_000       # texts are taken in slices of about this many code points


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class WordBPE:
    """Tables of one tokenizer file and the words encoded so far."""

    def __init__(self, spec: str):
        import regex

        d = json.loads(spec)
        model = d["model"]
        suffix = model.get("end_of_word_suffix") or ""
        if suffix != WORD_END or d.get("decoder") or d.get("post_processor"):
            raise ValueError("only vocabularies with word ends, without decoder and post-processor, are read")
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.split_special = regex.compile("|".join(sorted(map(regex.escape, self.special), key=len, reverse=True)) or "(?!)")
        first = d["pre_tokenizer"]["pretokenizers"][0]
        self.words = regex.compile(first["pattern"]["Regex"])
        vocab = model["vocab"]
        self.size = 1 + max([*vocab.values(), *self.special.values()])
        self.token = [""] * self.size
        for t, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = t
        self.byte = byte_symbols()
        back = {c: b for b, c in enumerate(self.byte)}
        # a token as its bytes; 256 marks the word's end
        paths = {i: [back[c] for c in t.removesuffix(suffix)] + [256] * t.endswith(suffix) for t, i in vocab.items() if t}
        self.unit = np.full(512, -1, np.int64)        # token of one byte, and of one byte that ends a word
        for i, p in paths.items():
            if len(p) == 1 and p[0] < 256:
                self.unit[p[0]] = i
            elif len(p) == 2 and p[1] == 256:
                self.unit[256 + p[0]] = i
        if (self.unit < 0).any():
            raise ValueError("the vocabulary lacks some single bytes")
        step, tok = [{}], [-1]
        for i, p in paths.items():
            at = 0
            for b in p:
                nxt = step[at].get(b)
                if nxt is None:
                    step.append({})
                    tok.append(-1)
                    nxt = step[at][b] = len(step) - 1
                at = nxt
            tok[at] = i
        # edges as sorted codes (node, symbol) and the nodes they lead to
        edges = np.array(sorted((at * 257 + b, nxt) for at, e in enumerate(step) for b, nxt in e.items()), np.int64)
        self.edge, self.edge_to = edges[:, 0].copy(), edges[:, 1].copy()
        self.trie_token = np.array(tok, np.int64)
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        self.made = np.full(self.size, -1, np.int64)     # merge that makes a token; -1: a single unit
        self.left = np.arange(self.size)
        self.right = np.arange(self.size)
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            pair = vocab[a], vocab[b]
            if pair not in self.rank:
                t = vocab[a + b]
                self.rank[pair] = r, t
                if self.made[t] < 0:
                    self.made[t], self.left[t], self.right[t] = r, *pair
        codes = np.array([a * self.size + b for a, b in self.rank], np.int64)
        order = np.argsort(codes)
        self.codes, self.code_rank = codes[order], np.array([r for r, _ in self.rank.values()], np.int64)[order]
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    # -- speculate ------------------------------------------------------------------
    def propose(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest matches of all words at once: (word index, token) in word order.

        ``symbols`` holds each word's bytes and then 256; ``ends`` lies after it.
        A match may not stop right before the word's end mark.
        """
        words, tokens, turns = [], [], []
        at, who, turn = starts.copy(), np.arange(len(starts)), 0
        while len(who):
            node = np.zeros(len(who), np.int64)
            pos, best, best_end = at.copy(), np.full(len(who), -1, np.int64), at.copy()
            live = np.arange(len(who))
            while len(live):
                code = node[live] * 257 + symbols[pos[live]]
                i = np.minimum(np.searchsorted(self.edge, code), len(self.edge) - 1)
                ok = self.edge[i] == code
                live, node_live = live[ok], self.edge_to[i[ok]]
                node[live] = node_live
                pos[live] += 1
                hit = self.trie_token[node_live]
                take = (hit >= 0) & (pos[live] != ends[who[live]] - 1)
                best[live[take]] = hit[take]
                best_end[live[take]] = pos[live[take]]
                live = live[pos[live] < ends[who[live]]]
            words.append(who)
            tokens.append(best)
            turns.append(np.full(len(who), turn))
            turn += 1
            more = best_end < ends[who]
            at, who = best_end[more], who[more]
        word, token, turn_of = map(np.concatenate, (words, tokens, turns))
        order = np.lexsort((turn_of, word))
        return word[order], token[order]

    # -- verify -----------------------------------------------------------------------
    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a * self.size + b
        i = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[i] == code, self.code_rank[i], np.iinfo(np.int64).max)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of tokens: no merge ever crosses the border between the two.

        x and y are the symbols at the border at some time, ``x_until`` and
        ``y_until`` the merges that consume them on their own side. A crossing
        merge wins if it comes before both; of equal merges the leftmost does.
        """
        never = np.iinfo(np.int64).max
        good = np.ones(len(a), bool)
        x, y = a.copy(), b.copy()
        x_until = np.full(len(a), never)
        y_until = np.full(len(a), never)
        live = np.arange(len(a))
        while len(live):
            xl, yl = x[live], y[live]
            m = self._rank_of(xl, yl)
            bad = (m < x_until[live]) & (m <= y_until[live]) & (m != never)
            good[live[bad]] = False
            live, xl, yl = live[~bad], xl[~bad], yl[~bad]
            mx, my = self.made[xl], self.made[yl]
            undo_x = mx > my
            undo_y = ~undo_x & (my >= 0)
            i, j = live[undo_x], live[undo_y]
            x_until[i], x[i] = mx[undo_x], self.right[xl[undo_x]]
            y_until[j], y[j] = my[undo_y], self.left[yl[undo_y]]
            live = live[undo_x | undo_y]
        return good

    def _verify(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        codes, inverse = np.unique(a * self.size + b, return_inverse=True)
        return self.compatible(codes // self.size, codes % self.size)[inverse]

    # -- exact merging ------------------------------------------------------------------
    def merge(self, units: list[int]) -> list[int]:
        """Lowest merge first, leftmost of equal ones, until none applies."""
        n = len(units)
        tok, nxt, prv = list(units), [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(self.rank[p][0], i, p) for i in range(n - 1) if (p := (tok[i], tok[i + 1])) in self.rank]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = nxt[i] if tok[i] >= 0 else -1
            if j < 0 or (tok[i], tok[j]) != pair:
                continue
            tok[i], tok[j] = self.rank[pair][1], -1
            nxt[i] = nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
            for k in (prv[i], i):
                if k >= 0 and nxt[k] >= 0 and (p := (tok[k], tok[nxt[k]])) in self.rank:
                    heapq.heappush(heap, (self.rank[p][0], k, p))
        return [t for t in tok if t >= 0]

    def units(self, data: bytes) -> list[int]:
        return [*self.unit[list(data[:-1])].tolist(), int(self.unit[256 + data[-1]])] if data else []

    # -- words and texts --------------------------------------------------------------------
    def learn(self, words: list[str]) -> None:
        """Encode word types and remember their ids as little-endian bytes."""
        data = [w.encode("utf-8") for w in words]
        size = np.array([len(d) + 1 for d in data])
        ends = np.cumsum(size)
        starts = ends - size
        symbols = np.full(int(ends[-1]), 256, np.int64)
        body = np.ones(len(symbols), bool)
        body[ends - 1] = False
        symbols[body] = np.frombuffer(b"".join(data), np.uint8)
        word, token = self.propose(symbols, starts, ends)
        fails = np.zeros(len(words), bool)
        inner = np.flatnonzero(word[1:] == word[:-1])
        if len(inner):
            fails[word[inner[~self._verify(token[inner], token[inner + 1])]]] = True
        ids = token.astype("<u4")
        cut = np.searchsorted(word, np.arange(len(words) + 1))
        raw = ids.tobytes()
        for k, w in enumerate(words):
            self.known[w] = raw[4 * cut[k]:4 * cut[k + 1]]
        for k in np.flatnonzero(fails):
            self.known[words[k]] = np.array(self.merge(self.units(data[k])), "<u4").tobytes()

    def pieces(self, text: str) -> list[str]:
        """Words and special strings of a text, in order.

        A word never looks like a special string, as the word pattern parts
        letters from other characters.
        """
        if not self.split_special.search(text):
            return self._words(text)
        out: list[str] = []
        at = 0
        for m in self.split_special.finditer(text):
            out += self._words(text[at:m.start()])
            out.append(m[0])
            at = m.end()
        return out + self._words(text[at:])

    def _words(self, text: str) -> list[str]:
        # the lower case of a capital sigma doesn't depend on its place here
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        split = [self.pieces(t) for t in texts]
        known = self.known
        if not known or len(known) > KNOWN_WORDS:
            known.clear()
            known.update({t: i.to_bytes(4, "little") for t, i in self.special.items()})
        new = list(set().union(*split) - known.keys())
        if new:
            self.learn(new)
        return [b"".join(map(known.__getitem__, s)) for s in split]

    def decode(self, ids: np.ndarray) -> str:
        return " ".join([self.token[i] for i in ids.tolist()])


_loaded: dict[bytes, WordBPE] = {}


def loaded(spec: bytes) -> WordBPE:
    """The tables of a tokenizer file, built once per worker."""
    key = hashlib.sha256(spec).digest()
    if key not in _loaded:
        _loaded[key] = WordBPE(spec.decode("utf-8"))
        release()               # what the tables were built from
    return _loaded[key]


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``limit`` code points, one text at least."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        if chars and chars + len(t) > limit:
            yield start, i
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield start, len(texts)


def bpe_encode(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256, and the ids on request.

    ``path`` names the tokenizer file; the driver reads it and broadcasts its
    text, a few MB that do not depend on the data.
    """
    ship_code(docs.sparkSession)
    with open(path, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
              ("decoded_sha256", pa.string())] + [("ids", pa.list_(pa.int32()))] * keep_ids
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(spec.value)
        for batch in batches:
            ids_in, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                codes = bpe.encode(texts[a:b])
                arrays = [np.frombuffer(c, "<u4") for c in codes]
                cols = [ids_in.slice(a, b - a).cast(pa.int64()), pa.array([len(x) for x in arrays], pa.int64()),
                        pa.array([hashlib.sha256(c).hexdigest() for c in codes]),
                        pa.array([hashlib.sha256(bpe.decode(x).encode("utf-8")).hexdigest() for x in arrays])]
                if keep_ids:
                    cols.append(pa.array([x.astype(np.int32) for x in arrays], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return pick(docs, "doc_id", "text").mapInArrow(releasing(run), ddl)
