"""Token counts by a linear longest-match automaton.

A word's greedy word pieces are the longest piece that starts it, then the longest
continuation piece that starts the rest, and so on; a word that can't be cut to its end
counts as one unknown token. The automaton finds how many pieces there are in one pass
without going back and without building a piece.

Nodes are the prefixes of pieces, in two tries: pieces that start a word and continuation
pieces. Each node v has a failure link f(v) and a number of popped tokens p(v): if the word
goes on where v has no edge, the text of v gives up p(v) tokens greedily, and what is left
of it is the text of f(v), a node of the continuation trie. For a node that is a piece
itself, f is the root of continuations and p is 1; else both follow from the parent's.

The vocabulary comes from a sentence-piece file: a piece with U+2581 in front starts a word,
any other piece continues one; byte, control and pure-space pieces are left out.

Defined cases: null and empty text have no words and no tokens; a word may be as long as
the text (time in proportion to its length); repeated rows count alike; a null key passes
through; an empty table gives an empty result; columns besides key and text are not read.
"""

from __future__ import annotations

import functools
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame

from tractlake.llm.common import SPACE_CLASS

SPACE = "▁"
KNOWN_WORDS = 1 << 18
LONG = 64  # characters; longer words (texts without spaces) are not kept
ROWS = 256
WORD = re.compile(SPACE_CLASS.replace("[", "[^") + "+")
START, REST = 0, 1


class Automaton:
    """Tries with failure links; ``count`` gives a word's number of pieces."""

    def __init__(self, starts, continuations):
        self.edge: list[dict[str, int]] = [{}, {}]
        final = [False, False]
        for root, pieces in ((START, starts), (REST, continuations)):
            for piece in pieces:
                v = root
                for c in piece:
                    w = self.edge[v].get(c)
                    if w is None:
                        w = self.edge[v][c] = len(self.edge)
                        self.edge.append({})
                        final.append(False)
                    v = w
                final[v] = v > REST
        # Shorter texts first, so that what a link leads to is already known.
        self.fail: list[int] = [-1] * len(self.edge)
        self.popped = [0] * len(self.edge)
        todo = deque([START, REST])
        while todo:
            u = todo.popleft()
            for c, v in self.edge[u].items():
                todo.append(v)
                if final[v]:
                    self.fail[v], self.popped[v] = REST, 1
                    continue
                z, popped = self.fail[u], self.popped[u]
                while z >= 0 and c not in self.edge[z]:
                    popped += self.popped[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[v], self.popped[v] = self.edge[z][c], popped

    def count(self, word: str) -> int:
        """Number of pieces of a non-empty word; -1 if it can't be cut."""
        u, n = START, 0
        edge, fail, popped = self.edge, self.fail, self.popped
        for c in word:
            while c not in edge[u]:
                if fail[u] < 0:
                    return -1
                n += popped[u]
                u = fail[u]
            u = edge[u][c]
        while fail[u] >= 0:
            n += popped[u]
            u = fail[u]
        return n if u == REST else -1


def vocabulary(model: str) -> tuple[list[str], list[str]]:
    """(pieces that start a word, pieces that continue one) of a sentence-piece file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    usable = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    starts = [p[1:] for p in usable if p.startswith(SPACE) and SPACE not in p[1:] and p != SPACE]
    return starts, [p for p in usable if SPACE not in p]


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Counter:
    """Counts of texts, with a bounded table of the words met before."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.known = automaton, {}

    def counts(self, text: str | None) -> tuple[int, int, int]:
        """Words, tokens, words that can't be cut (a token each)."""
        words = WORD.findall(text or "")
        known, pieces = self.known, 0
        if len(known) > KNOWN_WORDS:
            known.clear()
        new = set(words).difference(known)
        for w in new:
            known[w] = self.automaton.count(w)
        each = list(map(known.__getitem__, words))
        for w in new:
            if len(w) > LONG:
                del known[w]
        unknown = each.count(-1)
        pieces = sum(each) + 2 * unknown
        return len(words), pieces, unknown


@functools.lru_cache(maxsize=2)
def counter(model: str) -> Counter:
    return Counter(Automaton(*vocabulary(model)))


def _counting(model: str):
    def run(batches):
        tool = counter(model)
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                found = list(zip(*map(tool.counts, part.column(1).to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(x, pa.int64()) for x in found]],
                    ["key", "n_words", "n_tokens", "n_unknown"])
    return run


def token_counts(docs: DataFrame, *, key: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """key, n_words, n_tokens, n_unknown: one row per document."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(
        _counting(model or default_model()), f"key {kind}, n_words bigint, n_tokens bigint, n_unknown bigint")
