"""BPE encoding and decoding by a tokenization automaton.

The merges compile into a deterministic automaton over tokens that reads exactly the
token sequences BPE produces. It starts with one state that loops over all bytes. The
gadget of merge (u, v) -> w takes the state p behind u, which reads v: u leads to a copy
of p without v, and every state that reads u also reads w and goes where v led from p.
So a label alone names the state behind it. Copies are made on write: a state keeps its
parent, the merge at which it was copied and the labels cut from it, a label the merge
that added it; a transition is looked up through that chain once and then kept in the
state's table.

A word is encoded by the one path of the automaton that spells it, longest labels
first; decoding emits the labels of the arcs.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from formwork.llm.frames import map_text
from formwork.llm.tokens import SPLIT, PieceEncoder, Vocabulary, vocabulary_path

CACHED_WORDS = 400_000
_EVER = 1 << 60


class MergeAutomaton:
    def __init__(self, byte_labels: list[int], merges: list[tuple[int, int, int]]) -> None:
        self.parent: list[int] = [-1]
        self.born: list[int] = [-1]
        self.cut: dict[tuple[int, int], int] = {}
        self.added: dict[int, tuple[int, int]] = {}
        self.state = dict.fromkeys(byte_labels, 0)
        self.members = [len(byte_labels) + 1]  # the start of a word counts as well
        self.table: list[dict[int, bool]] = []
        for rank, (u, v, w) in enumerate(merges):
            self._gadget(rank, u, v, w)
        self.table = [{} for _ in self.parent]

    def _gadget(self, rank: int, u: int, v: int, w: int) -> None:
        if u not in self.state or v not in self.state or w in self.state:
            return
        p, target = self.state[u], self.state[v]
        if not self._reads(p, v, rank - 1):
            return
        if u == v or self.members[p] > 1:
            self.parent.append(p)
            self.born.append(rank)
            self.members[p] -= 1
            p = len(self.parent) - 1
            self.members.append(1)
            self.state[u] = p
        self.cut[p, v] = rank
        self.added[w] = (u, rank)
        self.state[w] = target
        self.members[target] += 1

    def _reads(self, q: int, label: int, when: int) -> bool:
        """Whether state q had a transition on the label after merge ``when``."""
        while True:
            if self.cut.get((q, label), _EVER + 1) <= when:
                return False
            u, rank = self.added.get(label, (label, -1))
            if rank > when:
                return False
            if self.born[q] > rank:
                q, when = self.parent[q], self.born[q] - 1
            elif rank < 0:
                return True
            else:
                label, when = u, rank

    def reads(self, q: int, label: int) -> bool:
        row = self.table[q]
        found = row.get(label)
        if found is None:
            found = row[label] = self._reads(q, label, _EVER)
        return found


class BpeCodec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.ids, self.labels = vocabulary.ids, vocabulary.labels
        self.automaton = MergeAutomaton([i for t, i in self.ids.items() if len(t) == 1], vocabulary.merges)
        self.reach: dict[bytes, int] = {}  # longest token by its first three bytes
        for t in self.ids:
            for head in {t[:3], t[:2]}:
                self.reach[head] = max(self.reach.get(head, 1), len(t))
        self.words: dict[str, bytes] = {}
        self.encode = PieceEncoder(self._piece, vocabulary.special)

    def path(self, word: bytes) -> list[int]:
        """The labels of the path that spells ``word``."""
        whole = self.ids.get(word)
        state, reads, ids, n = self.automaton.state, self.automaton.reads, self.ids, len(word)
        if whole is not None and whole in state:
            return [whole]
        path: list[int] = []
        ends = [0]
        reach = self.reach.get
        tried = [reach(word[:3], 2)]  # next length to try at each place of the path
        dead: set[tuple[int, int]] = set()
        while ends[-1] < n:
            at = ends[-1]
            q = state[path[-1]] if path else 0
            size = min(tried[-1], n - at)
            while size:
                label = ids.get(word[at : at + size])
                if label is not None and label in state and (at + size, label) not in dead and reads(q, label):
                    break
                size -= 1
            if size:
                tried[-1] = size - 1
                path.append(label)
                ends.append(at + size)
                tried.append(reach(word[at + size : at + size + 3], 2))
            else:
                dead.add((at, path.pop()))
                ends.pop()
                tried.pop()
        return path

    def _piece(self, text: str) -> bytes:
        words = self.words
        out = []
        for word in SPLIT.findall(text):
            found = words.get(word)
            if found is None:
                if len(words) >= CACHED_WORDS:
                    words.clear()
                found = words[word] = np.array(self.path(word.encode("utf-8", "surrogatepass")), "<u4").tobytes()
            out.append(found)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> BpeCodec:
    """The codec of a vocabulary file, compiled once per Python worker."""
    return BpeCodec(Vocabulary(path))


NEW = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])


def encode_decode(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Token ids of every text and the text decoded from them.

    Adds ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) and ``decoded`` to the
    columns of ``docs``; clashing names are replaced. ``vocabulary`` is the path of a
    byte-level BPE file on every worker (default: the installed 50k one). Null and
    empty texts have no tokens; special tokens in a text give their own ids; repeated
    rows give repeated results; no rows give no rows.
    """

    def make():
        c = codec(vocabulary or vocabulary_path())

        def run(texts: list[str]):
            for t in texts:
                ids = c.encode(t)
                yield len(ids) // 4, ids, c.decode(ids)

        return run

    return map_text(docs, text_col, NEW, make)
