"""Prefix tree over globally ordered token sets, for Jaccard similarity of at least ``num / den``.

Tokens are ordered by the number of documents that hold them, rarest first, the same
order for every tree.  A tree is path-compressed: an edge is a run of tokens, and a
node's sets are a range of the tree's order.  Two similar sets share a token among the
rarest ``n - need + 1`` of each (``need``: the least overlap of a set of n), so tree
positions are indexed by token as far as they lie in such a prefix.  A probe enters
the tree only where one of its own prefix tokens stands and no earlier one did, walks
down with the overlap counted so far, which all sets below share, and leaves a subtree
when the tokens that remain on either side could not reach the overlap that the
smallest set below would need.
"""

from __future__ import annotations

import numpy as np

FEW = 32  # sets of a subtree that are compared at once instead of walked


class Group:
    """Sets in tree order, their numbered tokens, the tree over them and its index."""

    def __init__(self, sets: list[np.ndarray], num: int = 80, den: int = 100, counts: list[np.ndarray] | None = None):
        """``counts``: documents of every token of every set; without it, those of the group."""
        self.num, self.den = num, den
        every = np.concatenate(sets)
        token, back, times = np.unique(every, return_inverse=True, return_counts=True)
        if counts is not None:
            times = np.zeros(len(token), np.int64)
            times[back] = np.concatenate(counts)
        rank = np.empty(len(token), np.int64)
        rank[np.lexsort((token, times))] = np.arange(len(token))
        parts = np.split(rank[back], np.cumsum([len(s) for s in sets])[:-1])
        numbered = [np.sort(p).astype(np.int32) for p in parts]
        self.order = sorted(range(len(sets)), key=lambda i: numbered[i].astype(">i4").tobytes())
        self.sets = [numbered[i] for i in self.order]
        self.size = np.array([len(s) for s in self.sets])
        self.prefix = self.size + 1 + -self.size * num // den  # n - need + 1
        self.mask = np.zeros(len(token), bool)
        self.label = np.arange(len(sets))
        self._changes = np.arange(len(sets))  # rises where the label of a set is not that of the set before it
        self.inside = np.zeros(len(sets), bool)
        self.nodes: list[tuple] = []          # first set, one past the last, depth of the parent, depth, children, least and most size
        self._build()
        self._index(len(token))

    def _build(self) -> None:
        sets, n = self.sets, len(self.sets)
        common = np.full(n + 1, -1)  # tokens that a set shares with the one before it from the start
        for i in range(1, n):
            a, b = sets[i - 1], sets[i]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            common[i] = differ[0] if len(differ) else m
        stack: list[list] = [[0, 0, []]]  # depth, first set and children of the open path
        for i in range(n):
            if len(sets[i]) > stack[-1][0]:
                stack.append([len(sets[i]), i, []])
            down, last = max(common[i + 1], 0), None
            while len(stack) > 1 and stack[-1][0] > down:
                depth, first, children = stack.pop()
                if last is not None:
                    children.append(last)
                up = max(stack[-1][0], down)
                last = self._node(first, i + 1, up, depth, children)
                if up > stack[-1][0]:
                    stack.append([up, first, [last]])
                    last = None
            if last is not None:
                stack[-1][2].append(last)

    def _node(self, first: int, stop: int, up: int, depth: int, children: list) -> int:
        sizes = self.size[first:stop]
        self.nodes.append((first, stop, int(up), int(depth), children, int(sizes.min()), int(sizes.max())))
        return len(self.nodes) - 1

    def _index(self, tokens: int) -> None:
        """Positions of the tree by token, as far as they lie in the prefix of a set below."""
        token, node, depth = [], [], []
        for k, (first, stop, up, down, *_) in enumerate(self.nodes):
            upto = min(down, int(self.prefix[first:stop].max()))
            if upto > up:
                token.append(self.sets[first][up:upto])
                node.append(np.full(upto - up, k))
                depth.append(np.arange(up, upto))
        token, node, depth = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (token, node, depth))
        order = np.argsort(token, kind="stable")
        self.at = np.concatenate([[0], np.cumsum(np.bincount(token, minlength=tokens))])
        self.entry_node, self.entry_depth = node[order], depth[order]
        part = lambda k: np.array([x[k] for x in self.nodes], np.int64)
        self.first, self.stop, self.least, self.most = part(0), part(1), part(5), part(6)
        self.flat = np.concatenate(self.sets)
        self.begin = np.concatenate([[0], np.cumsum(self.size)[:-1]])

    def classes(self, label: np.ndarray) -> None:
        """Sets with the same label are one class."""
        self.label = label
        self._changes = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])

    def join(self, a: int, b: int) -> None:
        """Sets ``a`` and ``b`` and all of their classes are one class from here on."""
        a, b = sorted((self.label[a], self.label[b]))
        if a != b:
            self.label[self.label == b] = a
            self.classes(self.label)

    def _entries(self, x: int, all_sets: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(node, depth, place in ``x``) where a prefix token of ``x`` stands and a similar set may be below."""
        own = self.sets[x][:self.prefix[x]]
        n = self.at[own + 1] - self.at[own]
        place = np.repeat(np.arange(len(own)), n)
        at = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.at[own], n)
        node, depth, size = self.entry_node[at], self.entry_depth[at], int(self.size[x])
        first, stop = self.first[node], self.stop[node]
        least, most = self.least[node], self.most[node]
        fit = (most * self.den >= size * self.num) & (size * self.den >= least * self.num)
        reach = 1 + np.minimum(size - place - 1, most - depth - 1)
        fit &= (self.num + self.den) * reach >= self.num * (size + least)
        if not all_sets:  # a later set of another class
            fit &= stop > x + 1
            fit &= (self._changes[stop - 1] != self._changes[first]) | (self.label[first] != self.label[x])
        return node[fit], depth[fit], place[fit]

    def _walk(self, x: int, k: int, up: int, all_sets: bool) -> tuple[list[tuple[int, int]], list[int]]:
        """(similar sets and overlaps, small subtrees that may hold more) below depth ``up`` of node ``k``, nothing above shared with ``x``."""
        own, n, num, den = self.sets[x], int(self.size[x]), self.num, self.den
        found, few, todo = [], [], [(k, up, 0)]
        while todo:
            k, up, overlap = todo.pop()
            first, stop, _, down, children, least, most = self.nodes[k]
            if stop - first <= FEW:
                few.append(k)
                continue
            if not all_sets and (stop <= x + 1 or (self._changes[stop - 1] == self._changes[first] and self.label[first] == self.label[x])):
                continue
            if most * den < n * num or n * den < least * num:
                continue
            edge = self.sets[first][up:down]
            overlap += int(np.count_nonzero(self.mask[edge]))
            rest = n - int(np.searchsorted(own, edge[-1], side="right"))
            if (num + den) * (overlap + min(rest, most - down)) < num * (n + least):
                continue
            if least == down:  # sets that end here
                at = first
                while at < stop and self.size[at] == down:
                    if (num + den) * overlap >= num * (n + down) and (all_sets or at > x):
                        found.append((at, overlap))
                    at += 1
            todo.extend((c, down, overlap) for c in children)
        return found, few

    def _overlaps(self, sets: np.ndarray) -> np.ndarray:
        """Overlap of each of the sets with the set in the mask."""
        size = self.size[sets]
        if 3 * size.sum() > len(self.flat):
            return np.add.reduceat(self.mask[self.flat], self.begin, dtype=np.int64)[sets]
        at = np.arange(size.sum()) + np.repeat(self.begin[sets] - np.cumsum(size) + size, size)
        return np.add.reduceat(self.mask[self.flat[at]], np.cumsum(size) - size, dtype=np.int64)

    def probe(self, x: int, all_sets: bool = True) -> list[tuple[int, int]]:
        """(set, overlap) of the sets similar to set ``x``; without ``all_sets`` only later ones, and subtrees of its own class are left out."""
        n, found, entered, few = int(self.size[x]), [], [], []
        self.mask[self.sets[x]] = True
        node, depth, _ = self._entries(x, all_sets)
        small = self.stop[node] - self.first[node] <= FEW
        for k, up in zip(node[~small].tolist(), depth[~small].tolist(), strict=True):
            a, b = int(self.first[k]), int(self.stop[k])
            if self.inside[a] and any(c <= a and b <= d for c, d in entered):
                continue  # an earlier token of both is on the path
            entered.append((a, b))
            self.inside[a:b] = True
            got, more = self._walk(x, k, up, all_sets)
            found.extend(got)
            few.extend(more)
        small = np.unique(np.concatenate([node[small], np.array(few, np.int64)]))
        if len(small):
            begin = np.zeros(len(self.sets) + 1, np.int64)
            np.add.at(begin, self.first[small], 1)
            np.add.at(begin, self.stop[small], -1)
            sets = np.flatnonzero(np.cumsum(begin)[:-1])
            size = self.size[sets]
            fit = (size * self.den >= n * self.num) & (n * self.den >= size * self.num)
            sets = sets[fit if all_sets else fit & (sets > x) & (self.label[sets] != self.label[x])]
            if len(sets):
                overlap = self._overlaps(sets)
                near = (self.num + self.den) * overlap >= self.num * (n + self.size[sets])
                seen = {y for y, _ in found}
                found.extend((y, o) for y, o in zip(sets[near].tolist(), overlap[near].tolist(), strict=True) if y not in seen)
        self.mask[self.sets[x]] = False
        for a, b in entered:
            self.inside[a:b] = False
        return found

    def components(self) -> np.ndarray:
        """Label of every set (in tree order): equal for sets linked directly or through others of the group."""
        for x in range(len(self.sets)):
            for y, _ in self.probe(x, all_sets=False):
                self.join(x, y)
        return self.label
