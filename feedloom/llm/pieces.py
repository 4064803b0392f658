"""SentencePiece BPE by vectorised merge rounds over flat symbol arrays.

A text is cut into words that no vocabulary piece can span. The words of a batch that have not been
seen lie in one flat numpy array; each round finds the best-ranked pair of every word,
merges its occurrences from the left at once and compacts the array, until no word has a
pair left. Ranks need not grow with length in a public vocabulary: where a fresh symbol
forms a pair at least as good as the one just merged, the occurrences right of it wait for the next
round, so the order of merges is that of one pair at a time.

Defined cases: null and empty texts give the begin and end id alone. Repeated rows and repeated or null
ids give one row each. An empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedloom.llm.common import short_batches

SPACE = "▁"
NONE = np.int32(2**31 - 1)
CACHE_WORDS = 600_000

codecs.register_error("per_byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceModel:
    """Lookup arrays of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = "a  ﬁ\n b "
        if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("only models with identity normalisation and a leading space are handled")
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(re.search(f"[^{SPACE}]{SPACE}", self.pieces[i]) for i in plain):
            raise ValueError("a piece spans two words")
        ids = {self.pieces[i]: i for i in plain}
        chars = {c for p in ids for c in p}
        # Equal scores share a rank; characters that are no piece get a symbol behind the pieces.
        scores = sorted({sp.get_score(i) for i in plain}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        symbols = dict(ids)
        for c in sorted(chars - ids.keys()):
            symbols[c] = size + len(symbols) - len(ids)
        self.width = size + len(symbols) - len(ids) + 1
        self.size = size
        self.of_char = np.full(0x110000, self.width - 1, np.int32)
        for c in chars:
            self.of_char[ord(c)] = symbols[c]
        rank = {p: rank_of[sp.get_score(i)] for p, i in ids.items()}
        keys, merged, ranks = [], [], []
        self.unsafe = np.zeros(size, bool)
        for p, i in ids.items():
            for cut in range(1, len(p)):
                left, right = p[:cut], p[cut:]
                if left in symbols and right in symbols:
                    keys.append(symbols[left] * self.width + symbols[right])
                    merged.append(i)
                    ranks.append(rank[p])
                    for part in (left, right):
                        if len(part) > 1 and part in rank and rank[part] >= rank[p]:
                            self.unsafe[ids[part]] = True
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.merged = np.array(merged, np.int32)[order]
        self.ranks = np.array(ranks, np.int32)[order]
        self.byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.uint32)
        # Characters of no piece, such as line breaks, separate words as well.
        self.barrier = "".join(c for c in "\n\t\r" if c not in chars)
        stop = re.escape(self.barrier)
        self.words = re.compile(f" *[^ {stop}]+| +" + (f"|[{stop}]" if stop else "")).findall
        raw = []
        for i, p in enumerate(self.pieces):
            if sp.is_control(i):
                raw.append(b"")
            elif sp.is_byte(i):
                raw.append(bytes([int(p[3:5], 16)]))
            elif sp.is_unknown(i):
                raw.append(" ⁇ ".encode())
            else:
                raw.append(p.replace(SPACE, " ").encode())
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_len = np.array([len(x) for x in raw], np.int64)
        self.raw_at = np.concatenate([[0], np.cumsum(self.raw_len)[:-1]])
        self.starts_with_space = np.array([p.startswith(SPACE) for p in self.pieces])
        self.cache: dict[str, bytes] = {}

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of neighbouring symbols; ``NONE`` where no piece is formed."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NONE), self.merged[at]

    def merge_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).replace(" ", SPACE).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym, word, at = self.of_char[code], np.repeat(np.arange(len(words)), lengths), np.arange(len(code))
        last = np.ones(len(sym), bool)
        last[:-1] = word[1:] != word[:-1]
        rank, into = self.pair_rank(sym, np.append(sym[1:], 0))
        rank[last] = NONE
        done_word, done_sym, done_at = [], [], []
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, first)
            best = np.repeat(best, np.diff(np.append(first, len(sym))))
            live = best != NONE
            if not live.all():
                over = ~live
                done_word.append(word[over])
                done_sym.append(sym[over])
                done_at.append(at[over])
                sym, word, at, rank, into, best = (x[live] for x in (sym, word, at, rank, into, best))
                if not len(sym):
                    break
            place = np.arange(len(sym))
            good = rank == best
            fresh = good & ~np.concatenate([[False], good[:-1]])
            run = np.maximum.accumulate(np.where(fresh, place, 0))
            pick = good & ((place - run) % 2 == 0)
            spot = np.flatnonzero(pick)
            spot = self._until_better(spot, sym, word, into, best)
            sym[spot] = into[spot]
            keep = np.ones(len(sym), bool)
            keep[spot + 1] = False
            moved = (np.cumsum(keep) - 1)[spot]
            sym, word, at, rank, into = (x[keep] for x in (sym, word, at, rank, into))
            touched = np.unique(np.concatenate([moved, moved[moved > 0] - 1]))
            after = np.minimum(touched + 1, len(sym) - 1)
            new_rank, new_into = self.pair_rank(sym[touched], sym[after])
            new_rank[(after == touched) | (word[after] != word[touched])] = NONE
            rank[touched], into[touched] = new_rank, new_into
        return self._gather(len(words), code, np.concatenate(done_word), np.concatenate(done_sym), np.concatenate(done_at))

    def _until_better(self, spot, sym, word, into, best):
        """Drop the merges of a word right of one whose new symbol has a pair of the same or a better rank."""
        risky = self.unsafe[into[spot]]
        if not risky.any():
            return spot
        own = into[spot]
        before, end = spot - 1, spot + 2
        joined = np.zeros(len(spot), bool)
        joined[1:] = spot[1:] - spot[:-1] == 2
        left = np.where(joined, np.concatenate([[0], own[:-1]]), sym[np.maximum(before, 0)])
        left_ok = (before >= 0) & (word[np.maximum(before, 0)] == word[spot])
        right_at = np.minimum(end, len(sym) - 1)
        right_ok = (end < len(sym)) & (word[right_at] == word[spot])
        left_rank = np.where(left_ok, self.pair_rank(left, own)[0], NONE)
        right_rank = np.where(right_ok, self.pair_rank(own, sym[right_at])[0], NONE)
        bad = risky & (np.minimum(left_rank, right_rank) <= best[spot])
        if not bad.any():
            return spot
        # Per word the number of bad merges before this one must be none.
        seen = np.cumsum(bad) - bad
        starts = np.flatnonzero(np.concatenate([[True], word[spot[1:]] != word[spot[:-1]]]))
        base = np.repeat(seen[starts], np.diff(np.append(starts, len(spot))))
        return spot[seen == base]

    def _gather(self, count, code, word, sym, at):
        order = np.lexsort((at, word))
        word, sym, at = word[order], sym[order], at[order]
        known = sym < self.size
        out_len = np.ones(len(sym), np.int64)
        ids = sym.astype(np.uint32)
        if known.all():
            flat, owner = ids, word
        else:
            spelled = {int(i): chr(code[at[i]]).encode("utf-8", "surrogatepass") for i in np.flatnonzero(~known)}
            for i, b in spelled.items():
                out_len[i] = len(b)
            flat, owner = np.repeat(ids, out_len), np.repeat(word, out_len)
            begin = np.cumsum(out_len) - out_len
            for i, b in spelled.items():
                flat[begin[i]:begin[i] + len(b)] = self.byte_id[np.frombuffer(b, np.uint8)]
        ends = np.cumsum(np.bincount(owner, minlength=count)) * 4
        data, start, result = flat.astype("<u4").tobytes(), 0, []
        for end in ends.tolist():
            result.append(data[start:end])
            start = end
        return result

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts with begin and end id, as little-endian 32-bit integers."""
        cut = [self.words(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        missing = list({w for words in cut for w in words} - self.cache.keys())
        for i in range(0, len(missing), 50_000):
            part = missing[i:i + 50_000]
            self.cache.update(zip(part, self.merge_words(part), strict=True))
        bos, eos = (np.array([x], "<u4").tobytes() for x in (self.bos, self.eos))
        get = self.cache.__getitem__
        return [bos + b"".join(map(get, words)) + eos for words in cut]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: bytes gathered piece by piece, without the leading space."""
        ids = ids[self.raw_len[ids] > 0]
        if not len(ids):
            return ""
        length = self.raw_len[ids]
        begin = np.cumsum(length) - length
        data = self.raw[np.repeat(self.raw_at[ids] - begin, length) + np.arange(int(length.sum()))].tobytes()
        if self.starts_with_space[ids[0]]:
            data = data[1:]
        return data.decode("utf-8", "per_byte")


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def digest_pieces(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, number of ids, SHA-256 of the ids and of the decoded text, per document."""
    short_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            encoded = model.encode_batch(texts)
            decoded = [model.decode(np.frombuffer(e, "<u4")) for e in encoded]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([len(e) // 4 for e in encoded], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in encoded], pa.string()),
                pa.array([hashlib.sha256(d.encode("utf-8")).hexdigest() for d in decoded], pa.string()),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
