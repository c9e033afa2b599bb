"""SentencePiece encoding and decoding with a batched numpy Viterbi.

The text is escaped as the piece model has it: a space becomes U+2581 and one is put in
front. Of all ways to cut it into pieces of the vocabulary, the one with the largest sum
of the model file's scores is taken (the unigram decision rule on the file's scores, not
its merge order). A character without a piece costs the smallest score less 10 and becomes
its UTF-8 bytes' pieces.

No piece of the vocabulary has U+2581 after another character, or a line feed at all, so
each such place is a cut and words are cut independently; a vocabulary for which that
isn't so is refused. The distinct words of a batch that aren't known yet are grouped by
length. Words of one length advance together, a character at a time: the hashes of all
substrings that end there come from prefix hashes, probe the sorted keys of the pieces of
that length, and the maxima over the lengths are kept with back-pointers (on a tie the
longest piece). The pieces found are compared with the words themselves, so a clash of
hashes can't change a result.

Decoding joins pieces and bytes, turns U+2581 into a space and drops the one in front. It
restores every text that has no U+2581 of its own (that character comes back as a space).

Defined cases: null and empty text have no ids and decode to the empty text; a text without
a space is one word however long it is (memory then grows with its length, not with the
length squared); repeated rows are encoded alike; a null key passes through; an empty table
gives an empty result; columns besides key and text are not read.
"""

from __future__ import annotations

import functools
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CELLS = 1 << 21
KNOWN_WORDS = 1 << 18
LONG = 64  # characters; longer words (texts without spaces) are not kept, and cut where no piece reaches over
PORTION = 1 << 22
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that multiplying by it loses nothing


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The vocabulary of one model file: sorted keys by length, scores, ids, byte pieces."""

    def __init__(self, model: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.piece = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.byte = {}
        normal = []
        for i, p in enumerate(self.piece):
            if sp.is_byte(i):
                self.byte[int(p[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                normal.append(i)
        if len(self.byte) < 256:
            raise ValueError(f"{model} has no byte pieces")
        if any(re.search(f"[^{SPACE}]{SPACE}|\n", self.piece[i]) for i in normal):
            raise ValueError(f"{model} has pieces across words")
        self.unknown = min(sp.get_score(i) for i in normal) - UNKNOWN_PENALTY
        self.score_of = {self.piece[i]: (sp.get_score(i), i) for i in normal}
        self.by_length = {}
        for n in sorted({len(self.piece[i]) for i in normal}):
            ids = np.array([i for i in normal if len(self.piece[i]) == n], np.int32)
            keys = _hashes(_codes([self.piece[i] for i in ids], n))[n]
            order = np.argsort(keys)
            self.by_length[n] = (keys[order], np.array([sp.get_score(int(i)) for i in ids])[order], ids[order],
                                 np.uint64(pow(int(BASE), n, 1 << 64)))
        self.bytes_of = [None] * len(self.piece)
        for b, i in self.byte.items():
            self.bytes_of[i] = bytes([b])
        for i in normal:
            self.bytes_of[i] = self.piece[i].replace(SPACE, " ").encode("utf-8", "surrogatepass")
        # Characters that some piece joins to others: between two, of which one isn't, every cut is free.
        joined = {c for i in normal if len(self.piece[i]) > 1 for c in self.piece[i]}
        self.runs = re.compile("[%s]+|[^%s]" % ((re.escape("".join(sorted(joined))),) * 2), re.S)
        self.known: dict[str, bytes] = {}  # ids as little-endian 32-bit integers

    # Encoding ------------------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """The words of a non-empty text. A word is listed without the U+2581 that starts it,
        or, if it starts a line, with NUL in place of the line feed (which has no piece)."""
        if SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.replace("\n", " \0").split(" ")
        # Several spaces in a row go with the word that follows them.
        cut = re.findall(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*", SPACE + text.replace(" ", SPACE))
        return [w[1:] if w[0] == SPACE else "\0" + w[1:] for w in cut]

    def learn(self, words) -> None:
        """Encode the words that aren't known yet, equal lengths together."""
        groups: dict[tuple[int, str], list[str]] = {}
        long = [w for w in words if len(w) > LONG]
        for w, ids in zip(long, self._long([w[1:] if w[:1] == "\0" else SPACE + w for w in long])):
            self.known[w] = np.array(self._unknown("\n"), "<i4").tobytes() + ids if w[:1] == "\0" else ids
        for w in words:
            if len(w) > LONG:
                continue
            start = w[:1] if w[:1] == "\0" else SPACE
            groups.setdefault((len(w) - 1 if start == "\0" else len(w) + 1, start), []).append(w)
        line = np.array(self._unknown("\n"), "<i4").tobytes()
        for (n, start), group in groups.items():
            step = max(1, CELLS // max(1, n))
            for a in range(0, len(group), step):
                part = group[a:a + step]
                if start == SPACE:
                    self.known.update(zip(part, self._viterbi([SPACE + w for w in part], n)))
                else:
                    rest = self._viterbi([w[1:] for w in part], n) if n else [b""] * len(part)
                    self.known.update((w, line + x) for w, x in zip(part, rest))

    def _long(self, words: list[str]) -> list[bytes]:
        """ids of long words. A word is cut into runs of characters that pieces join and single
        ones; its best cut is that of the runs. Short runs of all words advance together, a long
        one goes alone over the list of its pieces."""
        cut = [self.runs.findall(w) for w in words]
        by_length: dict[int, list[str]] = {}
        for r in {r for runs in cut for r in runs}:
            by_length.setdefault(len(r), []).append(r)
        ids = {}
        for n, group in by_length.items():
            if n > LONG:
                ids.update((r, self._listed(r)) for r in group)
                continue
            step = max(1, CELLS // n)
            for a in range(0, len(group), step):
                part = group[a:a + step]
                ids.update(zip(part, self._viterbi(part, n)))
        return [b"".join(map(ids.__getitem__, runs)) for runs in cut]

    def _listed(self, word: str) -> bytes:
        """The same cut of one long run: the pieces at all places are probed at once, and the
        maxima run over what was found."""
        n = len(word)
        power = np.ones(n + 1, np.uint64)
        power[1:] = np.cumprod(np.full(n, BASE, np.uint64))
        back = np.uint64(pow(int(BASE), -1, 1 << 64))
        shrink = np.cumprod(np.full(n, back, np.uint64))
        codes = _codes([word], n)[:, 0] + np.uint64(1)
        prefix = np.zeros(n + 1, np.uint64)
        prefix[1:] = np.cumsum(codes * shrink) * power[1:]
        found = []
        for k, (keys, scores, ids, times) in self.by_length.items():
            if k > n:
                break
            probe = prefix[k:] - prefix[:-k] * times
            at = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == probe)
            found.append(np.stack([hit + k, np.full(len(hit), k), at[hit]]))
        hits = np.concatenate(found, axis=1)
        hits = hits[:, np.argsort(hits[0], kind="stable")]  # by end, shorter pieces first
        first = np.searchsorted(hits[0], np.arange(n + 2)).tolist()
        length, row = hits[1].tolist(), hits[2].tolist()
        score = {k: x[1].tolist() for k, x in self.by_length.items()}
        piece = {k: x[2].tolist() for k, x in self.by_length.items()}
        best, taken, chosen = [0.0] * (n + 1), [1] * (n + 1), [-1] * (n + 1)
        for end in range(1, n + 1):
            top, t, c = best[end - 1] + self.unknown, 1, -1
            for j in range(first[end], first[end + 1]):
                k = length[j]
                total = best[end - k] + score[k][row[j]]
                if total >= top:
                    top, t, c = total, k, piece[k][row[j]]
            best[end], taken[end], chosen[end] = top, t, c
        steps, end = [], n
        while end:
            steps.append([chosen[end]] if chosen[end] >= 0 else self._unknown(word[end - 1]))
            end -= taken[end]
        ids = list(chain.from_iterable(reversed(steps)))
        if b"".join([self.bytes_of[i] for i in ids]) != word.replace(SPACE, " ").encode("utf-8", "surrogatepass"):
            ids = self._plain(word)
        return np.array(ids, "<i4").tobytes()

    def _viterbi(self, words: list[str], n: int) -> list[bytes]:
        prefix = _hashes(_codes(words, n))
        many = len(words)
        best = np.zeros((n + 1, many))
        taken, piece = np.ones((n + 1, many), np.int32), np.full((n + 1, many), -1, np.int32)
        for end in range(1, n + 1):
            top = best[end]
            np.add(best[end - 1], self.unknown, out=top)
            for k, (keys, scores, ids, power) in self.by_length.items():
                if k > end:
                    break
                probe = prefix[end] - prefix[end - k] * power
                at = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
                hit = np.flatnonzero(keys[at] == probe)
                at = at[hit]
                total = best[end - k][hit] + scores[at]
                up = total >= top[hit]
                hit, at = hit[up], at[up]
                top[hit], taken[end, hit], piece[end, hit] = total[up], k, ids[at]
        # Back along the pointers, all words at once; 0 where a word has come to its start.
        steps, place, row = [], np.full(many, n), np.arange(many)
        while (place > 0).any():
            found = piece[place, row]
            steps.append(np.where(place > 0, np.where(found >= 0, found, -1 - place), 0))
            place = np.where(place > 0, place - taken[place, row], 0)
        cells = np.array(steps[::-1], np.int32).T
        used = cells != 0
        ends = np.cumsum(used.sum(axis=1)).tolist()
        flat = cells[used]
        if (flat > 0).all():
            # A piece has as many characters as its probe, so equal sums of all mean equal words.
            spelt = b"".join(map(self.bytes_of.__getitem__, flat.tolist()))
            if spelt == "".join(words).replace(SPACE, " ").encode("utf-8", "surrogatepass"):
                data = flat.astype("<i4").tobytes()
                return [data[4 * a:4 * b] for a, b in zip([0, *ends], ends)]
        out, flat = [], flat.tolist()
        for w, a, b in zip(words, [0, *ends], ends):
            ids = list(chain.from_iterable([c] if c > 0 else self._unknown(w[-c - 2]) for c in flat[a:b]))
            if b"".join([self.bytes_of[i] for i in ids]) != w.replace(SPACE, " ").encode("utf-8", "surrogatepass"):
                ids = self._plain(w)
            out.append(np.array(ids, "<i4").tobytes())
        return out

    def _unknown(self, char: str) -> list[int]:
        return [self.byte[b] for b in char.encode("utf-8", "surrogatepass")]

    def _plain(self, word: str) -> list[int]:
        """The same cut without hashes, for a word whose probes clashed."""
        most = max(self.by_length)
        best: list[tuple[float, int, int]] = [(0.0, 0, -1)]
        for end in range(1, len(word) + 1):
            choice = (best[end - 1][0] + self.unknown, 1, -1)
            for k in range(1, min(most, end) + 1):
                found = self.score_of.get(word[end - k:end])
                if found and best[end - k][0] + found[0] >= choice[0]:
                    choice = (best[end - k][0] + found[0], k, found[1])
            best.append(choice)
        ids, end = [], len(word)
        while end:
            _, k, i = best[end]
            ids[:0] = [i] if i >= 0 else self._unknown(word[end - 1])
            end -= k
        return ids

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        odd = [bool(t) and "\0" in t for t in texts]  # NUL stands for line feeds above
        new: set[str] = set()
        for text, plain in zip(texts, odd):
            if text and not plain:
                new.update(self.words(text))
        self.learn(new.difference(self.known))
        known = self.known.__getitem__
        out = [np.frombuffer(b"" if not t else self._odd(t) if plain else b"".join(map(known, self.words(t))), "<i4")
               for t, plain in zip(texts, odd)]
        for w in new:
            if len(w) > LONG:
                self.known.pop(w, None)
        return out

    def _odd(self, text: str) -> bytes:
        cut = re.findall(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*", SPACE + text.replace(" ", SPACE))
        return b"".join(self._long(cut))

    def decode(self, ids) -> str:
        spelt = b"".join([self.bytes_of[i] or b"" for i in ids])
        return spelt[1:].decode("utf-8", "replace") if spelt[:1] == b" " else spelt.decode("utf-8", "replace")


def _codes(words: list[str], n: int) -> np.ndarray:
    """Code points, a row for each place in the words."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.ascontiguousarray(flat.reshape(len(words), n).T).astype(np.uint64)


def _hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes: row j has those of the first j characters."""
    out = np.zeros((len(codes) + 1, codes.shape[1]), np.uint64)
    for j in range(len(codes)):
        out[j + 1] = out[j] * BASE + codes[j] + np.uint64(1)
    return out


@functools.lru_cache(maxsize=2)
def load(model: str) -> Pieces:
    """The vocabulary, once per Python worker."""
    return Pieces(model)


def _portions(batch):
    """Slices of a batch with about ``PORTION`` bytes of text (or one longer row)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PORTION, "right")))
        yield batch.slice(a, b - a)
        a = b


def _encoder(model: str, digest: bool, check: bool = False):
    def run(batches):
        vocab = load(model)
        for batch in batches:
            for part in _portions(batch):
                texts = part.column(1).to_pylist()
                found = vocab.encode_batch(texts)
                many = pa.array([len(x) for x in found], pa.int64())
                if not digest:
                    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                    same = [pa.array([vocab.decode(x.tolist()) == (t or "") for x, t in zip(found, texts)])] if check else []
                    yield pa.RecordBatch.from_arrays([part.column(0), ids, many, *same],
                                                     ["key", "ids", "n_tokens", *["round_trip"] * check])
                    continue
                same = [vocab.decode(x.tolist()) == (t or "") for x, t in zip(found, texts)]
                crc = [zlib.crc32(x.tobytes()) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), many, pa.array(crc, pa.int64()), pa.array(same)],
                    ["key", "n_tokens", "ids_crc32", "round_trip"])
    return run


def encode(docs: DataFrame, *, key: str = "doc_id", text: str = "text", model: str | None = None,
           check: bool = False) -> DataFrame:
    """key, ids (array of int), n_tokens: one row per document, in the order of ``docs``. With
    ``check`` also round_trip, whether decoding the ids gives the text again."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(
        _encoder(model or default_model(), False, check),
        f"key {kind}, ids array<int>, n_tokens bigint" + ", round_trip boolean" * check)


def encode_and_check(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                     model: str | None = None) -> DataFrame:
    """key, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers), round_trip:
    whether decoding the ids gives the text again."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(
        _encoder(model or default_model(), True),
        f"key {kind}, n_tokens bigint, ids_crc32 bigint, round_trip boolean")


def decode(rows: DataFrame, *, key: str = "key", ids: str = "ids", model: str | None = None) -> DataFrame:
    """key, text: the texts of rows of ids; null ids give the empty text."""
    kind, path = rows.schema[key].dataType.simpleString(), model or default_model()

    def run(batches):
        vocab = load(path)
        for batch in batches:
            texts = [vocab.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])
    return rows.select(rows[key].alias("key"), rows[ids].alias("ids")).mapInArrow(run, f"key {kind}, text string")
