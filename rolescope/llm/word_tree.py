"""The words of a class as leaves of a binary tree whose decisions depend on the context."""

from __future__ import annotations

import numpy as np

from rolescope.llm.base import mix

_U = np.uint64
# Layers of counts in a class, and parts of the vocabulary by hash (not those of a Spark task).
LAYERS, PARTS = 64, 512
# Pairs of a word and a context taken at a time: their decisions stay in the processor's cache.
SLICE, WORDS = 1 << 14, 1 << 13  # (and words whose decisions are listed at a time)
SURE = 40.0  # log odds of the only side that a decision has
GROUPS = ("ending", "word")  # of contexts, each learned on what those before it leave
UNIT = 256.0  # sums of gradients are whole numbers of 1 / UNIT, the same in any order


def layer(count: np.ndarray) -> np.ndarray:
    """The half octave of a count: 1, 2, 3, 4 to 5, 6 to 7, 8 to 11, ... have numbers 0, 2, 3, ..."""
    part, power = np.frexp(np.maximum(count, 1).astype(np.float64))
    return np.minimum(2 * (power.astype(np.int64) - 1) + (part >= 0.75), LAYERS - 1)


def part_of(code: np.ndarray) -> np.ndarray:
    """The part of a word by its hash (its lowest 32 bits are enough)."""
    return (code.astype(_U) >> _U(8)).astype(np.int64) & (PARTS - 1)


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...``: ``size[i]`` numbers for each i."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def context_hash(values: np.ndarray, salt: int) -> np.ndarray:
    """32-bit hashes of contexts, none of them 0: that is a context which says nothing."""
    return mix(values.astype(_U) + _U(salt)).astype(np.uint32) | np.uint32(1)


class Tree:
    """The upper part of the trees, one a class, and the sizes that give all the rest.

    A class's words are in layers of about equal count. Layers are parted by half of their training
    tokens, a layer's words by half of their number, so a word takes about as many decisions as its
    share of the class has bits, and without a context it has this share, to within the breadth of
    a layer. No word is held: a word's place in its layer follows from the sizes of the parts and
    its rank in its own part.
    """

    def __init__(self, sizes: np.ndarray, mass: np.ndarray, classes: int):
        """``sizes``: words by layer of a class and by part; ``mass``: training tokens by layer."""
        self.sizes = sizes.sum(axis=1)
        self.offsets = (np.cumsum(sizes, axis=1) - sizes).astype(np.uint32)
        paths: list[list[tuple]] = [[] for _ in range(classes * LAYERS)]

        def split(cells):
            if len(cells) < 2:
                return
            below = np.cumsum(mass[cells])
            cut = int(np.argmin(np.abs(below[:-1] - below[-1] / 2))) + 1
            odds = float(np.log(below[-1] - below[cut - 1]) - np.log(below[cut - 1]))
            for side, sign in ((cells[:cut], -1.0), (cells[cut:], 1.0)):
                for cell in side:
                    paths[cell].append((cells[cut], sign, sign * odds))
                split(side)

        for k in range(classes):
            split(np.flatnonzero(mass[k * LAYERS:(k + 1) * LAYERS]) + k * LAYERS)
        self.bits = np.array([int(max(n - 1, 0)).bit_length() for n in self.sizes])
        self.length = np.array([len(p) for p in paths], dtype=np.int64)
        self.first = np.cumsum(self.length) - self.length
        flat = np.array([x for p in paths for x in p], dtype=np.float64).reshape(-1, 3)
        self.node = mix(flat[:, 0].astype(_U)).astype(np.uint32)
        self.sign, self.odds = flat[:, 1].astype(np.float32), flat[:, 2].astype(np.float32)


class Paths:
    """The decisions that lead to each word of a vocabulary, word after word.

    ``node`` is a decision's hash, ``sign`` the side that the word is on and ``odds`` the log odds
    of this side before any context is heard. A decision whose other side is empty is as good as
    sure. Words of count 0 have no path.
    """

    def __init__(self, tree: Tree, count: np.ndarray, cls: np.ndarray, code: np.ndarray,
                 rank: np.ndarray):
        known = np.flatnonzero(count > 0)
        cell = cls[known] * LAYERS + layer(count[known])
        place = tree.offsets[cell, part_of(code[known])] + rank[known]
        self.length = np.zeros(len(count), dtype=np.int64)
        self.length[known] = tree.length[cell] + tree.bits[cell]
        ends = np.cumsum(self.length)
        self.first = ends - self.length
        total = int(ends[-1]) if len(ends) else 0
        self.node = np.empty(total, dtype=np.uint32)
        self.sign, self.odds = np.empty(total, dtype=np.int8), np.zeros(total, dtype=np.float32)
        for low in range(0, len(known), WORDS):
            block = slice(low, low + WORDS)
            words = known[block]
            self._fill(tree, slice(int(self.first[words[0]]), int(ends[words[-1]])),
                       self.length[words], cell[block], place[block])

    def _fill(self, tree: Tree, where: slice, length: np.ndarray, cell: np.ndarray,
              place: np.ndarray) -> None:
        """The decisions of some words that follow each other."""
        node, sign, odds = self.node[where], self.sign[where], self.odds[where]
        size, ends = tree.sizes[cell], np.cumsum(length)
        # first as if all were decisions by place; those of the layers then go over the upper ones
        of = np.repeat(np.arange(len(cell)), length)
        level = np.repeat(ends - 1, length) - np.arange(len(node))
        side = place.take(of) >> level
        sign[:] = 2 * (side & 1) - 1
        node[:] = side >> 1
        node *= np.uint32(0x85EBCA6B)
        node ^= mix(cell.astype(_U) + _U(1 << 32)).astype(np.uint32).take(of)
        node += level.astype(np.uint32) * np.uint32(0xC2B2AE35)
        node ^= node >> np.uint32(15)
        node *= np.uint32(0x2C1B3C6D)
        node ^= node >> np.uint32(13)
        right = size.take(of) - ((side | 1) << level)
        edge = np.flatnonzero(right < 1 << level)  # the right side is not full, or empty
        right, full = right[edge], 1 << level[edge]
        some = np.flatnonzero(right > 0)
        found = np.full(len(edge), -SURE)
        found[some] = np.log(right[some]) - np.log(full[some])
        odds[edge] = sign[edge] * found
        own = tree.length[cell]
        to, of = _spread(ends - length, own), _spread(tree.first[cell], own)
        node[to], sign[to], odds[to] = tree.node[of], tree.sign[of], tree.odds[of]

    def steps(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many decisions each of the words has, and where they are."""
        number = self.length.take(words)
        return number, _spread(self.first.take(words), number)

    def cells(self, at: np.ndarray, number: np.ndarray, context: np.ndarray, cells: int,
              ) -> np.ndarray:
        """Where decisions have their weights for a context each word; ``cells`` if it is 0."""
        found = np.repeat(context, number)
        silent = None if context.all() else found == 0
        found ^= self.node.take(at)
        found *= np.uint32(0x9E3779B1)
        found >>= np.uint32(33 - cells.bit_length())
        if silent is not None:
            found[silent] = cells
        return found.astype(np.intp)

    def log_odds(self, at: np.ndarray, number: np.ndarray, contexts: list[np.ndarray],
                 tables: list[np.ndarray], sign: np.ndarray) -> np.ndarray:
        """Log odds of the sides that the words are on, with the weights of their contexts."""
        z = np.zeros(len(at), dtype=np.float32)
        for context, table in zip(contexts, tables):
            z += table.take(self.cells(at, number, context, len(table) - 1))
        z *= sign
        z += self.odds.take(at)
        return z

    def log_share(self, words: np.ndarray, before: np.ndarray, contexts: list[np.ndarray],
                  tables: list[np.ndarray]) -> np.ndarray:
        """log10 P(word | class, context) of each of the words (0 for those without a path).

        ``contexts`` holds hashes by group, which ``before`` points to, and ``tables`` weights.
        """
        out = np.zeros(len(words))
        for low in range(0, len(words), SLICE):
            part = slice(low, low + SLICE)
            number, at = self.steps(words[part])
            own = [c.take(before[part]) for c in contexts]
            z = self.log_odds(at, number, own, tables, self.sign.take(at))
            logs = np.exp(np.negative(z, out=z), out=z)
            logs += 1
            np.log(logs, out=logs)
            some = np.flatnonzero(number)
            if len(some):
                starts = (np.cumsum(number) - number)[some]
                out[low + some] = np.add.reduceat(logs, starts) / -np.log(10)
        return out

    def learn(self, words: np.ndarray, count: np.ndarray, before: np.ndarray,
              contexts: list[np.ndarray], tables: list[np.ndarray], sums: np.ndarray) -> None:
        """Add what ``count`` tokens of each word say of the next table's weights to ``sums``.

        The upper 32 bits of a sum hold the gradient of the log-likelihood, the lower ones its
        second derivative, in units of 1 / ``UNIT``.
        """
        for low in range(0, len(words), SLICE):
            part = slice(low, low + SLICE)
            number, at = self.steps(words[part])
            own = [c.take(before[part]) for c in contexts[:len(tables) + 1]]
            sign = self.sign.take(at)
            miss = np.exp(self.log_odds(at, number, own, tables, sign))
            miss += 1
            np.reciprocal(miss, out=miss)
            weight = np.repeat((count[part] * UNIT).astype(np.float32), number) * miss
            push = np.rint(weight * sign).astype(np.int64)
            push <<= 32
            push += np.rint(weight * (1 - miss)).astype(np.int64)
            np.add.at(sums, self.cells(at, number, own[-1], len(sums) - 1), push)


def weights(push: np.ndarray, curve: np.ndarray, ridge: float) -> np.ndarray:
    """Weights after a Newton step for each of them alone; the last is that of no context.

    A step is at most 2, that of a decision even before which a context always takes one way.
    """
    out = np.clip(push / (curve + ridge), -2, 2).astype(np.float32)
    out[-1] = 0
    return out
