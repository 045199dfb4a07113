"""The last token of every prefix of a byte string under a byte-pair encoding, for many strings at a time.

The last token decides: token t ends prefix p if the prefix before t ends in token s and the pair (s, t) stands when s and t
are encoded together. Exactly one such t exists for each p, so no prefix is ever encoded again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from drayage.llm.lookup import NONE, Lookup

#: Bits of the table that remembers which pairs of tokens stand; a forgotten pair is worked out anew.
PAIR_BITS = 20
#: Long strings are cut into stretches of so many bytes, each begun so many bytes early.
STRETCH, EARLY = 1024, 384
#: From so many rows on, rows are worked out together; below, one string after the other.
TOGETHER, AT_ONCE = 48, 2048


class LastTokens:
    def __init__(self, tokens: list[bytes], encode: Callable[[bytes], list[bytes]]):
        """tokens: those that encode to themselves; encode: the encoding of a short byte string."""
        self.encode, self.token = encode, sorted(tokens)
        self.longest = max(map(len, self.token))
        self.stretch, self.early = max(STRETCH, 2 * self.longest), max(EARLY, 2 * self.longest)
        nodes, token, steps = {b"": 0}, [-1], []
        for n, t in enumerate(self.token):
            for k in range(1, len(t) + 1):
                if t[:k] not in nodes:
                    nodes[t[:k]] = len(nodes)
                    token.append(-1)
                    steps.append((nodes[t[: k - 1]] << 8 | t[k - 1], nodes[t[:k]]))
            token[nodes[t]] = n
        self.step = Lookup(np.array([k for k, _ in steps], np.int64), np.array([v for _, v in steps], np.int32))
        self.node_token = np.array(token, np.int32)
        self.pair_key, self.pair_ok = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)

    def stand(self, pairs: np.ndarray) -> np.ndarray:
        """Whether two tokens, numbered in the halves of each pair, stay apart when encoded together."""
        slot = ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        ok, new = self.pair_ok[slot], np.flatnonzero(self.pair_key[slot] != pairs)
        if len(new):
            each, first, at = np.unique(pairs[new], return_index=True, return_inverse=True)
            found = np.fromiter((self.encode(self.token[x >> 32] + self.token[x & 0xFFFFFFFF]) == [self.token[x >> 32], self.token[x & 0xFFFFFFFF]] for x in each.tolist()), bool, len(each))
            ok[new] = found[at]
            self.pair_key[slot[new[first]]], self.pair_ok[slot[new[first]]] = each, found
        return ok

    def together(self, data: np.ndarray, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(last token, count of tokens) of data[:, :p] at [p] for rows of bytes, which with `sizes` get shorter downwards."""
        m, n = data.shape
        last, count = np.full((n + 1, m), -1, np.int32), np.zeros((n + 1, m), np.uint32)
        every = np.arange(m)
        row, begin, node = every[:0], every[:0], np.zeros(0, np.int32)
        upto = np.full(n + 1, m) if sizes is None else m - np.searchsorted(sizes[::-1], np.arange(n + 1), side="left")
        for p in range(1, n + 1):
            k = int(upto[p])
            if sizes is not None and p > 1 and k < upto[p - 1]:
                on = row < k
                row, begin, node = row[on], begin[on], node[on]
            row, begin, node = np.concatenate([row, every[:k]]), np.concatenate([begin, np.full(k, p - 1)]), np.concatenate([node, np.zeros(k, np.int32)])
            node = self.step(node.astype(np.int64) << 8 | data[row, p - 1])
            on = node != NONE
            row, begin, node = row[on], begin[on], node[on]
            token = self.node_token[node]
            can = np.flatnonzero(token >= 0)
            before = last[begin[can], row[can]].astype(np.int64)
            good = before < 0
            some = np.flatnonzero(~good)
            good[some] = self.stand(before[some] << 32 | token[can[some]])
            can = can[good]
            last[p, row[can]], count[p, row[can]] = token[can], count[begin[can], row[can]] + 1
            if len(can) != k:
                raise AssertionError("not one last token for each prefix")
        return last, count

    def _tokens_at(self, data: bytes) -> tuple[list[int], list[int], list[int]]:
        """All tokens anywhere in data by their end: (where each end's tokens begin in the lists, first byte, token)."""
        b = np.frombuffer(data, np.uint8)
        q, node, depth, found = np.arange(len(b)), np.zeros(len(b), np.int64), 0, []
        while len(q):
            node = self.step(node.astype(np.int64) << 8 | b[q + depth])
            depth += 1
            on = node != NONE
            q, node = q[on], node[on]
            t = self.node_token[node]
            hit = t >= 0
            found.append((q[hit] + depth, q[hit], t[hit]))
            on = q + depth < len(b)
            q, node = q[on], node[on]
        end, begin, token = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(end, kind="stable")
        return np.searchsorted(end[order], np.arange(len(b) + 2)).tolist(), begin[order].tolist(), token[order].tolist()

    def one(self, data: bytes, last: list[int] | None = None, count: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The same for one string; with `last` and `count` of its first bytes it goes on from there."""
        last, count = (last, count) if last else ([-1], [0])
        at, begin, token = self._tokens_at(data)
        seen: dict[int, bool] = {}
        for p in range(len(last), len(data) + 1):
            for k in range(at[p], at[p + 1]):
                s = last[begin[k]]
                pair = s << 32 | token[k]
                ok = s < 0 or seen.get(pair)
                if ok is None:
                    ok = seen[pair] = bool(self.stand(np.array([pair]))[0])
                if ok:
                    last.append(token[k])
                    count.append(count[begin[k]] + 1)
                    break
            else:
                raise AssertionError("no last token")
        return np.array(last, np.int32), np.array(count, np.uint32)

    def strings(self, data: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(last token, count of tokens) at 0 to len for each byte string, of any length.

        A long string is worked out as several stretches. A stretch holds if it agrees with the one before over the bytes of a
        longest token, as later bytes depend on nothing else; one that does not is worked out again from there.
        """
        early, stretch = self.early, self.stretch
        rows = [(k, a) for k, d in enumerate(data) for a in range(0, max(1, len(d)), stretch)]
        if len(rows) < TOGETHER:
            return [self.one(d) for d in data]
        parts: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        whole = sorted(rows, key=lambda r: -(min(len(data[r[0]]), r[1] + stretch) - max(0, r[1] - early)))
        for g in range(0, len(whole), AT_ONCE):
            group = [(k, a, data[k][max(0, a - early) : a + stretch]) for k, a in whole[g : g + AT_ONCE]]
            sizes = np.array([len(x) for _, _, x in group])
            block = np.zeros((len(group), sizes[0]), np.uint8)
            for r, (_, _, x) in enumerate(group):
                block[r, : len(x)] = np.frombuffer(x, np.uint8)
            last, count = self.together(block, sizes)
            for r, (k, a, x) in enumerate(group):
                parts[k, a] = (last[: len(x) + 1, r].copy(), count[: len(x) + 1, r].copy())
        return [self._joined(d, [parts[k, a] for a in range(0, max(1, len(d)), stretch)]) for k, d in enumerate(data)]

    def _joined(self, data: bytes, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        if len(parts) == 1:
            return parts[0]
        last, count = np.full(len(data) + 1, -1, np.int32), np.zeros(len(data) + 1, np.uint32)
        for j, (x, c) in enumerate(parts):
            a = j * self.stretch
            begin, end = max(0, a - self.early), min(len(data), a + self.stretch)
            if not a:
                last[: end + 1], count[: end + 1] = x, c
                continue
            window = slice(a - self.longest, a + 1)
            own = slice(window.start - begin, window.stop - begin)
            ahead = count[window].astype(np.int64) - c[own]
            if (last[window] == x[own]).all() and (ahead == ahead[0]).all():
                last[a : end + 1], count[a : end + 1] = x[a - begin :], c[a - begin :] + ahead[0]
            else:
                x, c = self.one(data[begin:end], last[begin : a + 1].tolist(), count[begin : a + 1].tolist())
                last[a : end + 1], count[a : end + 1] = x[a - begin :], c[a - begin :]
        return last, count
