"""Byte-pair encoding by dynamic programming over prefixes.

For every prefix of a piece exactly one token can be the last of the prefix's
own encoding. ``last[i]`` holds it, so the encoding of any prefix is read off
backwards, appending goes on from the stored table, and an edit needs new
entries only until they agree with the old ones again. A token may follow
another exactly if merging the two tokens' text leaves that border standing;
:meth:`MergeTable.stands` decides that from the merges alone, without encoding.

Symbols are bytes. ``END`` (a byte that UTF-8 never has) marks a word's end in
vocabularies whose last symbol carries it.
"""

from __future__ import annotations

END = b"\xff"
#: Pieces that a worker remembers (bounds its memory, not its answers); heads and borders follow this number.
REMEMBER = 700_000
HEADS = (5, 8, 11)


class MergeTable:
    """Tokens by their bytes, the rank at which two neighbours merge, and each token's last merge.

    ``rank_of(left, right)`` gives the rank of merging two token ids, or None.
    """

    def __init__(self, ids: dict[bytes, int], pair_rank: dict[tuple[int, int], int] | None = None, remember: int = REMEMBER):
        self.most_heads, self.most_borders = remember // 3, remember * 2 // 3
        self.ids = ids
        self.text = {i: b for b, i in ids.items()}
        self.longest = max(map(len, ids))
        self.pairs = pair_rank
        self.rank, self.parts = {}, {}
        for b, i in ids.items():
            self._learn(b, i)
        self.live = {b: i for b, i in ids.items() if i in self.rank}       # tokens that merging ever makes
        self._border: dict[tuple[int, int], bool] = {}
        self._heads: dict[bytes, list[int]] = {}

    def rank_of(self, left: int, right: int) -> int | None:
        if self.pairs is not None:
            return self.pairs.get((left, right))
        return self.ids.get(self.text[left] + self.text[right])

    def symbols(self, piece: bytes) -> list[int]:
        if piece[-1:] == END:
            return [self.ids[piece[i:i + 1]] for i in range(len(piece) - 2)] + [self.ids[piece[-2:]]]
        return [self.ids[piece[i:i + 1]] for i in range(len(piece))]

    def merge(self, piece: bytes) -> tuple[list[int], tuple[int, int, int] | None]:
        """Plain merging, lowest rank first and leftmost among equals; also the last merge made."""
        out, last = self.symbols(piece), None
        while len(out) > 1:
            best = min(((r, k) for k in range(len(out) - 1) if (r := self.rank_of(out[k], out[k + 1])) is not None), default=None)
            if best is None:
                break
            r, k = best
            last = (out[k], out[k + 1], r)
            out[k:k + 2] = [self.ids[self.text[out[k]] + self.text[out[k + 1]]]]
        return out, last

    def _learn(self, b: bytes, i: int) -> None:
        single = len(b) == 1 or len(b) == 2 and b[1:] == END
        if single:
            self.rank[i] = -1
            return
        out, last = self.merge(b)
        if out == [i]:
            self.parts[i], self.rank[i] = last[:2], last[2]

    def stands(self, left: int, right: int) -> bool:
        """Whether the border between two neighbouring tokens survives merging their joined text.

        Both tokens are taken apart along the border, latest merge first. The
        pieces that touch the border at one time would merge if their joint
        rank came before the merge that took either of them in; on the left
        an equal rank goes first (leftmost wins), on the right the border pair does.
        """
        key = (left, right)
        known = self._border.get(key)
        if known is not None:
            return known
        x, y, until_x, until_y = left, right, float("inf"), float("inf")
        ok = True
        while True:
            r = self.rank_of(x, y)
            if r is not None and r < until_x and r <= until_y:
                ok = False
                break
            rx, ry = self.rank[x], self.rank[y]
            if rx < 0 and ry < 0:
                break
            if rx >= ry:      # equal ranks: the left one was merged first, so the right one is undone first
                if rx == ry and ry >= 0:
                    until_y, y = ry, self.parts[y][0]
                else:
                    until_x, x = rx, self.parts[x][1]
            else:
                until_y, y = ry, self.parts[y][0]
        if len(self._border) > self.most_borders:
            self._border.clear()
        self._border[key] = ok
        return ok

    def step(self, piece: bytes, i: int, last: list[int]) -> int:
        """The one token that ends the encoding of ``piece[:i]``, given the table for the shorter prefixes."""
        get, border = self.live.get, self._border.get
        for j in range(i - self.longest if i > self.longest else 0, i):
            t = get(piece[j:i])
            if t is not None:
                if j == 0:
                    return t
                before = last[j]
                if before >= 0:
                    ok = border((before, t))
                    if ok or ok is None and self.stands(before, t):
                        return t
        raise ValueError("a byte of the text is no token of the vocabulary")

    def table(self, piece: bytes, last: list[int] | None = None) -> list[int]:
        """``last[i]`` for every prefix; a given table of a shorter prefix is gone on with (exact append)."""
        last = [-1] if last is None else last
        step, add, end = self.step, last.append, len(piece)
        if piece[-1:] == END:
            for i in range(len(last), end - 1):
                add(step(piece, i, last))
            if len(last) < end:
                add(-1)          # the symbol before END is one with it: no token ends between the two
            add(step(piece, end, last))
            return last
        for i in range(len(last), end + 1):
            add(step(piece, i, last))
        return last

    def read(self, piece: bytes, last: list[int], end: int | None = None) -> list[int]:
        """The encoding of ``piece[:end]``, read backwards from the table."""
        i, out = len(piece) if end is None else end, []
        while i > 0:
            out.append(last[i])
            i -= len(self.text[last[i]])
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        """The encoding of a piece; pieces that begin alike go on from the stored table of their common head."""
        return self.read(piece, self.table(piece, self._head(piece, len(piece) - 2)))

    def _head(self, piece: bytes, most: int) -> list[int]:
        size = HEADS[-1] if most >= HEADS[-1] else max((h for h in HEADS if h <= most), default=0)
        if not size:
            return [-1]
        head = piece[:size]
        found = self._heads.get(head)
        if found is None:
            if len(self._heads) > self.most_heads:
                self._heads.clear()
            found = self._heads[head] = self.table(head, self._head(head, size - 1))
        return found[:]

    def edit(self, piece: bytes, last: list[int], start: int, end: int, new: bytes) -> tuple[bytes, list[int]]:
        """Replace ``piece[start:end]`` by ``new``: entries are computed anew only until they agree with the old ones.

        An entry depends on the ``longest`` bytes and entries before it, so
        once that many entries past the edit agree, all later ones do.
        """
        edited = piece[:start] + new + piece[end:]
        out, agree, shift = last[:start + 1], 0, len(new) - (end - start)
        for i in range(start + 1, len(edited) + 1):
            out.append(self.step(edited, i, out))
            old = i - shift
            agree = agree + 1 if i > start + len(new) and old > end and last[old] == out[i] else 0
            if agree > self.longest:
                out.extend(last[old + 1:])
                break
        return edited, out

    def counts(self, piece: bytes) -> list[int]:
        """Token count of every prefix (``-1`` where a marked word cannot be cut)."""
        last, out = self.table(piece), [0]
        for i in range(1, len(last)):
            out.append(-1 if last[i] < 0 else out[i - len(self.text[last[i]])] + 1)
        return out
