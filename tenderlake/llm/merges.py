"""What a merge list says of its encodings: which tokens can stand side by side, and how far ahead decides that.

Merges are made in the order of the list, of equal ones the one further left first.
Two tokens can stand side by side if no merge across their border comes before the
merges that close them on either side (``side_by_side``). A sequence of tokens that
the merges reach is the encoding of its bytes exactly if all its neighbours can.

Lookahead. Let a token t end at byte p of a text. What comes behind p can change t
only by a merge (s, z) across p, where s is t or one of the tokens on its right
edge, made before s is absorbed inside t. For that z has to be there at its rank,
which in turn only a merge of a still lower rank across the end of z can prevent.
So whether the merge (s, z) is made is decided by

    reach(s, z) = |z| + the largest reach(s', z') of a merge of lower rank whose s' is
                  on the right edge of z and not absorbed by then

bytes behind its border: ranks fall from step to step, so this is well defined and
computed in the order of the list. The largest reach of a merge that can touch the
right edge of any token is the ``lookahead``: a token that ends that many bytes before
the last one read is final, whatever follows.
"""

import bisect
import json

LAST = 1 << 60  #: a rank after all merges


def byte_symbols() -> dict[str, int]:
    """Printable symbol of every byte in byte-level vocabularies: Latin-1's visible ones stand for themselves."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class MergeList:
    """Tokens and merges of a byte-level vocabulary file."""

    def __init__(self, model_file: str, pairs_held: int = 1 << 19):
        with open(model_file, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, symbols = spec["model"]["vocab"], byte_symbols()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(symbols[c] for c in t) for t, i in vocabulary.items() if t not in self.special}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for n, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            pair = vocabulary[a], vocabulary[b]
            self.rank[pair] = n
            self.parts.setdefault(vocabulary[a + b], pair)
        self.edges: dict[int, tuple[list, list]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pairs_held = pairs_held

    def spine(self, token: int, right: bool) -> list[tuple[int, int]]:
        """Tokens on the right (left) edge while the token is built, with the rank at which each is absorbed."""
        out, until = [], LAST
        while True:
            out.append((token, until))
            if token not in self.parts:
                return out
            until = self.rank[self.parts[token]]
            token = self.parts[token][right]

    def side_by_side(self, a: int, b: int, below: int = LAST) -> bool:
        """Whether no merge across the border of a and b (of rank under ``below``) comes before both sides are closed.

        Of equal merges the one further left is made first: a merge across the
        border goes after an equal one inside a, and before an equal one inside b.
        """
        for token in (a, b):
            if token not in self.edges:
                self.edges[token] = self.spine(token, True), self.spine(token, False)
        for x, x_until in self.edges[a][0]:
            for y, y_until in self.edges[b][1]:
                m = self.rank.get((x, y))
                if m is not None and m < below and m < x_until and m <= y_until:
                    return False
        return True

    def follows(self, a: int, b: int) -> bool:
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= self.pairs_held:
                self.pairs.clear()
            found = self.pairs[a, b] = self.side_by_side(a, b)
        return found

    def order(self, token: int) -> int:
        """Bytes (by id), then tokens in the order of their merges."""
        return self.rank[self.parts[token]] if token in self.parts else token - LAST

    def reached(self) -> dict[bytes, int]:
        """Tokens that the merges reach, by their bytes: the halves may stand side by side but for the merge that joins them."""
        ordinary = [i for i in self.bytes_of if i not in self.special.values() and (len(self.bytes_of[i]) == 1 or i in self.parts)]
        return {self.bytes_of[i]: i for i in ordinary if i not in self.parts or self.side_by_side(*self.parts[i], below=self.rank[self.parts[i]])}

    def lookahead(self) -> int:
        """Bytes behind a token's end after which it is final (see above)."""
        behind: dict[int, tuple[list[int], list[int]]] = {}  # left half: ranks of its merges so far, and their largest reach

        def reach(token: int, until: int) -> int:
            most = 0
            for s, absorbed in self.spine(token, True):
                ranks, reaches = behind.get(s, ((), ()))
                k = bisect.bisect_left(ranks, min(absorbed, until))
                if k:
                    most = max(most, reaches[k - 1])
            return most

        for (s, z), n in sorted(self.rank.items(), key=lambda x: x[1]):
            own = len(self.bytes_of[z]) + reach(z, n)
            ranks, reaches = behind.setdefault(s, ([], []))
            ranks.append(n)
            reaches.append(max(own, reaches[-1] if reaches else 0))
        return max((reach(t, LAST) for t in self.bytes_of if t not in self.special.values()), default=0)
