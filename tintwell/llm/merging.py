"""Merge-type encoding of many units at once, and of one unit of any length, with candidates left out by turn."""

from __future__ import annotations

import heapq
from array import array

import numpy as np

from tintwell.llm.tables import Table

_NONE = np.int32(2**31 - 1)
#: Joins of two characters below this code point are looked up by both at once.
_NEAR = 0x200


class Merger:
    """Joins neighbouring symbols by a vocabulary: the best score first, the leftmost among equals.

    ids: pieces and their ids; every piece must come out of merging its own text. score: of each piece. byte_ids: the ids
    for the bytes of a character outside the vocabulary; literal: bytes that stand for a character of its own.
    """

    def __init__(self, ids: dict[str, int], score: dict[str, float], byte_ids: list[int], literal: dict[str, bytes]):
        self.byte_ids, self.literal = byte_ids, {ord(c): b for c, b in literal.items()}
        self.letter = np.full(0x110000, -1, np.int32)
        pairs: dict[int, int] = {}
        for piece, i in ids.items():
            if len(piece) == 1:
                self.letter[ord(piece)] = i
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        self.pairs = pairs
        self.whole = Table(len(pairs))
        self.whole.put(np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))
        near = np.arange(_NEAR)
        self.first = self._joined(np.repeat(self.letter[near], _NEAR), np.tile(self.letter[near], _NEAR)).reshape(_NEAR, _NEAR)
        #: Rank of each piece, the best score first.
        self.rank = np.full(max(ids.values(), default=0) + 1, _NONE, np.int32)
        order = sorted(ids.items(), key=lambda x: (-score[x[0]], x[1]))
        self.rank[[i for _, i in order]] = np.arange(len(order))
        self.by_rank = [i for _, i in order]
        self.first = np.where(self.first >= 0, self.rank[self.first], _NONE)

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        out = np.full(len(left), -1, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        out[todo] = self.whole.get(left[todo].astype(np.int64) << 32 | right[todo])
        return out

    def _firsts(self, code: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rank of the join of each character with the next; none at the ends of units."""
        out = np.full(len(code), _NONE, np.int32)
        near = code < _NEAR
        near[:-1] &= near[1:]
        near[ends] = False
        at = np.flatnonzero(near)
        out[at] = self.first[code[at], code[at + 1]]
        near[ends] = True
        at = np.flatnonzero(~near)
        whole = self._joined(self.letter[code[at]], self.letter[code[at + 1]])
        out[at] = np.where(whole >= 0, self.rank[whole], _NONE)
        return out

    def _symbols(self, code: np.ndarray) -> np.ndarray:
        """A symbol for each character: a piece's id, or for one outside the vocabulary its code point negated less 2."""
        known = self.letter[code]
        return np.where(known >= 0, known, -2 - code)

    def spelled(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids with the bytes of each character outside the vocabulary in its place, and how many ids each symbol became."""
        n, odd = np.ones(len(flat), np.int64), np.flatnonzero(flat < 0)
        if not len(odd):
            return flat, n
        made = [self.literal.get(c) or chr(c).encode("utf-8", "surrogatepass") for c in (-2 - flat[odd]).tolist()]
        n[odd] = [len(b) for b in made]
        out = np.repeat(flat, n)
        out[out < 0] = [self.byte_ids[b] for b in b"".join(made)]
        return out, n

    def many(self, units: list[str], skips: list[tuple[int, ...]] | None = None, least: int = 1, lost=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all units, how many each has, how many turns each takes).

        A unit's candidates at its turns in skips are left out, or those that lost(places of units, turn) tells. A unit is left as it is when only `least` symbols are left. Units are worked in groups of like length, so that a few thousand of them share each step.
        """
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        order = np.argsort(sizes, kind="stable")
        ascending, at = sizes[order], 0
        done, counts, turns = [], np.zeros(len(units), np.int64), np.zeros(len(units), np.int16)
        while at < len(order):
            size = int(ascending[at])
            to = min(int(np.searchsorted(ascending, size + max(1, size // 8), side="right")), at + max(1, min(20_000, 600_000 // (size + 1))))
            places = order[at:to]
            flat, counts[places], turns[places] = self._group([units[i] for i in places.tolist()], [skips[i] for i in places.tolist()] if skips else [], least, lost and (lambda rows, turn, of=places: lost(of[rows], turn)))
            done.append(flat)
            at = to
        flat = np.concatenate([np.zeros(0, np.int32), *done])
        starts = np.zeros(len(units), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        ends = np.cumsum(counts)
        return flat[np.repeat(starts - (ends - counts), counts) + np.arange(len(flat))], counts, turns

    def _group(self, units: list[str], skips: list[tuple[int, ...]], least: int, lost) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, width = len(units), max(map(len, units))
        skipped = np.zeros((n, 1 + max((t[-1] for t in skips if t), default=-1)), bool)
        known = lost or (lambda rows, turn: skipped[rows, turn] if turn < skipped.shape[1] else None)
        rows = [(r, t) for r, ts in enumerate(skips) for t in ts]
        if rows:
            skipped[tuple(np.array(rows).T)] = True
        turns, left = np.zeros(n, np.int16), np.fromiter(map(len, units), np.int64, n)
        # A symbol stands at its first character, -1 where there is none; the one after it at after, which is also where it ends.
        sym = np.full((n, width + 2), -1, np.int32)
        inside = np.arange(width)[None, :] < left[:, None]
        code = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32)
        sym[:, :width][inside] = self._symbols(code)
        stride = width + 2
        flat = sym.reshape(-1)
        after = np.tile(np.arange(1, width + 3, dtype=np.int32), n)
        before = np.tile(np.arange(-1, width + 1, dtype=np.int32), n)

        def candidates(row: np.ndarray, c: np.ndarray) -> np.ndarray:
            """Rank of the join of the symbol at c with the next; none where there is none."""
            at = row + c
            whole = self._joined(flat[at], flat[row + np.minimum(after[at], width)])
            return np.where(whole >= 0, self.rank[whole], _NONE)

        if width > 1:
            agenda = np.full((n, stride), _NONE, np.int32)
            agenda[:, :width][inside] = self._firsts(code, np.cumsum(left) - 1)
            cells, live, turn = agenda.reshape(-1), np.flatnonzero(left > least), 0
            while len(live):
                own = agenda if len(live) == n else agenda[live]
                best = own.argmin(1)
                more = own[np.arange(len(live)), best] < _NONE
                live, best = live[more], best[more]
                turns[live] += 1
                rest = live
                skip = known(live, turn)
                if skip is not None:
                    agenda[live[skip], best[skip]] = _NONE
                    live, best = live[~skip], best[~skip]
                turn += 1
                row = live * stride
                at = row + best
                j = after[at]
                k = after[row + j]
                flat[at] = self._joined(flat[at], flat[row + j])
                flat[row + j], cells[row + j] = -1, _NONE
                after[at], before[row + np.minimum(k, width + 1)] = k, best
                cells[at] = candidates(row, best)
                p = before[at]
                ok = p >= 0
                cells[row[ok] + p[ok]] = candidates(row[ok], p[ok])
                left[live] -= 1
                live = rest[left[rest] > least] if least > 1 else rest
        filled = sym != -1
        ids, grown = self.spelled(sym[filled])
        owner = np.repeat(np.arange(n), filled.sum(1))
        return ids, np.bincount(owner, grown, n).astype(np.int64), turns

    def parted(self, pieces: dict[str, int]) -> None:
        """Learn the last merge of each piece, for stays()."""
        names = [p for p in pieces if len(p) > 1]
        ids, n, _ = self.many(names, least=2)
        if (n != 2).any():
            raise ValueError("a piece is not made of two")
        whole = np.array([pieces[p] for p in names])
        self.left_part, self.right_part = np.full(len(self.rank), -1, np.int32), np.full(len(self.rank), -1, np.int32)
        self.left_part[whole], self.right_part[whole] = ids[::2], ids[1::2]
        #: The place of a piece in the order of merges; no merge makes a character.
        self.made = np.where(self.left_part >= 0, self.rank, -1)
        if (self.made[ids[::2]] >= self.made[whole]).any() or (self.made[ids[1::2]] >= self.made[whole]).any():
            raise ValueError("a piece has a better score than a part of it")

    def stays(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two pieces, encoded together, stay the two: merges at their border are looked for backwards in time.

        Each step takes back the later merge of the two pieces, of equal ones the right piece's. Had the symbols at the
        border made a piece that comes before that merge, they would have been joined.
        """
        out, at = np.ones(len(left), bool), np.arange(len(left))
        a, b, limit = left.astype(np.int64), right.astype(np.int64), np.full(len(left), _NONE, np.int64)
        while len(at):
            whole = self._joined(a, b)
            early = (whole >= 0) & (self.made[whole] < limit)
            out[at[early]] = False
            m, n = self.made[a], self.made[b]
            go = ~early & ((m >= 0) | (n >= 0))
            at, a, b, m, n = at[go], a[go], b[go], m[go], n[go]
            first = m > n
            limit = np.where(first, m, n + 1)
            a, b = np.where(first, self.right_part[a], a), np.where(first, b, self.left_part[b])
        return out

    def one(self, unit: str, skip) -> np.ndarray:
        """Ids of a unit of any length; skip(first, n) tells for n turns from the first on which lose their candidate."""
        n = len(unit)
        code = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32)
        sym = array("i", self._symbols(code).astype(np.int32).tobytes())
        after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        ranks = self._firsts(code, np.array([n - 1]))
        agenda = array("i", ranks.tobytes())
        at = np.flatnonzero(ranks < _NONE)
        first = np.sort(ranks[at].astype(np.int64) << 32 | at)  # those that are there from the start, in order
        later: list[int] = []
        pairs, rank, by_rank = self.pairs, self.rank, self.by_rank
        coming, turn, drawn = 0, 0, np.zeros(0, bool)
        while coming < len(first) or later:
            if coming < len(first) and (not later or first[coming] < later[0]):
                entry, coming = int(first[coming]), coming + 1
            else:
                entry = heapq.heappop(later)
            i, r = entry & 0xFFFFFFFF, entry >> 32
            if agenda[i] != r:
                continue
            agenda[i] = _NONE
            if turn % 65536 == 0:
                drawn = skip(turn, 65536 if n > 1024 else 4 * n)
            lost = drawn[turn % 65536]
            turn += 1
            if lost:
                continue
            j = after[i]
            k = after[j]
            sym[i], sym[j], agenda[j], after[i] = by_rank[r], -1, _NONE, k
            if k < n:
                before[k] = i
            for p in (before[i], i):
                if p < 0:
                    continue
                q = after[p]
                made = pairs.get(sym[p] << 32 | sym[q], -1) if q < n and sym[p] >= 0 and sym[q] >= 0 else -1
                agenda[p] = rank[made] if made >= 0 else _NONE
                if made >= 0:
                    heapq.heappush(later, int(rank[made]) << 32 | p)
        left = np.frombuffer(sym, np.int32)
        return self.spelled(left[left != -1])[0]
