"""Token counts by greedy longest match, one step per byte, without building the pieces.

The vocabulary is a trie of byte strings. Where the trie has no step for the next byte, the
failure link of the node leads to the state in which a greedy matcher would be after giving
out the longest pieces so far; how many pieces it gives out is stored with the link. So a
word takes as many steps as it has bytes, and only counts are added up.
"""

from __future__ import annotations

from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import load_ranks
from .common import text_of
from .pieces import Remembered

#: Tokens that begin with a blank start a word, all others go on with one.
VOCABULARY = "byte_bpe_50k.tiktoken"
_NOWHERE = -1


class LongestMatch:
    """Counts the pieces of a word; -1 where the vocabulary cannot spell it."""

    def __init__(self, tokens):
        step, ends, children = {}, {0: False}, [[]]
        for token in tokens:
            node = 0
            for byte in token:
                child = step.get((node << 8) | byte)
                if child is None:
                    child = step[(node << 8) | byte] = len(children)
                    children.append([])
                    children[node].append((byte, child))
                node = child
            ends[node] = True
        fail, popped = [_NOWHERE] * len(children), [0] * len(children)
        level = [0]
        while level:                        # breadth first: links lead to shorter strings
            below = []
            for node in level:
                for byte, child in children[node]:
                    below.append(child)
                    if ends.get(child):
                        fail[child], popped[child] = 0, 1
                        continue
                    at, count = fail[node], popped[node]
                    while at != _NOWHERE and (at << 8 | byte) not in step:
                        count += popped[at]
                        at = fail[at]
                    if at != _NOWHERE:
                        fail[child], popped[child] = step[(at << 8) | byte], count
            level = below
        self.step, self.fail, self.popped = step, fail, popped

    def __call__(self, word: bytes) -> int:
        step, fail, popped, node, count = self.step, self.fail, self.popped, 0, 0
        for byte in word:
            while (after := step.get((node << 8) | byte)) is None:
                if fail[node] == _NOWHERE:
                    return -1
                count += popped[node]
                node = fail[node]
            node = after
        while node:
            if fail[node] == _NOWHERE:
                return -1
            count += popped[node]
            node = fail[node]
        return count


@cache
def _counter(vocabulary: str) -> Remembered:
    match = LongestMatch(load_ranks(vocabulary))
    return Remembered(lambda word: match(b" " + word))


def count_tokens(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_tokens, n_unknown``.

    Words are what stands between ASCII white space; a word is matched with a blank in
    front. A word that the vocabulary cannot spell counts as one token and as unknown (with
    a vocabulary of all bytes there is none). NULL and empty texts have none of each;
    repeated rows count alike; an empty table stays empty; other columns are dropped.
    """
    def run(batches):
        pieces = _counter(vocabulary)
        for batch in batches:
            words, tokens, unknown = [], [], []
            for value in batch.column(1).to_pylist():
                counts = [pieces[w] for w in value.encode().split()]
                missing = counts.count(-1)
                words.append(len(counts))
                tokens.append(sum(counts) + 2 * missing)
                unknown.append(missing)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))],
                ["doc_id", "n_words", "n_tokens", "n_unknown"])

    given = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long, n_unknown long")
