"""An Aho-Corasick automaton over word numbers, in NumPy arrays.

A state stands for the first words of some pattern; states are numbered by depth, the root is 0.
State k > 0 is entered from ``keys[k - 1] // width`` by the word ``keys[k - 1] % width``, and the
keys rise, so a step is a search in one sorted array.  ``fail`` is the state of the longest shorter
end that begins a pattern, ``out`` the nearest state on that way, itself included, where a pattern
ends.  That is 20 bytes and less a state, shared by all that a pattern begins with.

A text is read once.  Long texts and many texts are cut into segments that are read in step with
each other, one word of each at a time; a segment begins ``depth - 1`` words early, which is as far
as a state can reach back.
"""

from __future__ import annotations

import numpy as np

SEGMENT = 512  # words of a segment


class Automaton:
    def __init__(self, patterns: list[np.ndarray], owners: np.ndarray, width: int):
        """``patterns`` hold numbers from 1 to ``width`` - 1, each with a group of equal length as rows."""
        self.width, self.depth = width, max((p.shape[1] for p in patterns), default=0)
        keys, fail, out, ends = [], [np.zeros(1, np.int32)], [np.zeros(1, np.int32)], []
        at = [np.zeros(len(p), np.int64) for p in patterns]
        made = 0
        for d in range(self.depth):
            own = [k for k, p in enumerate(patterns) if p.shape[1] > d]
            entered, back = np.unique(
                np.concatenate([at[k] * width + patterns[k][:, d] for k in own]), return_inverse=True
            )
            keys.append(entered)
            self.keys = np.concatenate(keys)
            back = back + made + 1
            cuts = np.cumsum([len(patterns[k]) for k in own])[:-1]
            for k, states in zip(own, np.split(back, cuts)):
                at[k] = states
            self.fail = np.concatenate(fail)
            short = self._step(self.fail[entered // width], entered % width) if d else np.zeros(len(entered), np.int64)
            fail.append(short.astype(np.int32))
            last = np.zeros(len(entered), bool)
            for k in own:
                if patterns[k].shape[1] == d + 1:
                    last[at[k] - made - 1] = True
                    ends.append(k)
            before = np.concatenate(out)
            out.append(np.where(last, np.arange(made + 1, made + 1 + len(entered)), before[short]).astype(np.int32))
            made += len(entered)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.fail, self.out = np.concatenate(fail), np.concatenate(out)
        # of each state where patterns end: their length and owners
        state = np.concatenate([at[k] for k in ends]) if ends else np.zeros(0, np.int64)
        length = np.concatenate([np.full(len(at[k]), patterns[k].shape[1]) for k in ends]) if ends else state
        first = np.cumsum([0, *(len(p) for p in patterns)])
        owner = np.concatenate([owners[first[k] : first[k + 1]] for k in ends]) if ends else state
        rows = np.unique(np.column_stack([state, length, owner]), axis=0) if len(state) else np.zeros((0, 3), np.int64)
        self.end_state, self.end_length, self.end_owner = rows.T.copy()

    def bytes(self) -> int:
        return self.keys.nbytes + self.fail.nbytes + self.out.nbytes + 3 * self.end_state.nbytes

    def _step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The states after one more word; word 0 is in no pattern."""
        after = np.zeros(len(state), np.int64)
        open_ = np.flatnonzero(word)
        state, word = state[open_].astype(np.int64), word[open_].astype(np.int64)
        while len(open_):
            key = state * self.width + word
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            after[open_[found]] = at[found] + 1
            on = ~found & (state > 0)
            open_, word, state = open_[on], word[on], self.fail[state[on]].astype(np.int64)
        return after

    def states(self, words: np.ndarray) -> np.ndarray:
        """The state after each word; texts are told apart by a 0 between them."""
        n, ahead = len(words), max(0, self.depth - 1)
        if not n or not len(self.keys):
            return np.zeros(n, np.int64)
        rows = -(-n // SEGMENT)
        line = np.zeros(ahead + rows * SEGMENT, np.int64)
        line[ahead : ahead + n] = words
        segments = np.lib.stride_tricks.as_strided(line, (rows, ahead + SEGMENT), (8 * SEGMENT, 8)).T.copy()
        state, out = np.zeros(rows, np.int64), np.empty((SEGMENT, rows), np.int64)
        for k, word in enumerate(segments):
            state = self._step(state, word)
            if k >= ahead:
                out[k - ahead] = state
        return out.T.ravel()[:n]

    def hits(self, words: np.ndarray):
        """(end, length, owner): every occurrence of a pattern, once for each owner; ``end`` is its last word."""
        end, state = np.arange(len(words)), self.out[self.states(words)].astype(np.int64)
        found = []
        while True:
            some = state > 0
            end, state = end[some], state[some]
            if not len(end):
                break
            low, high = (np.searchsorted(self.end_state, state, side) for side in ("left", "right"))
            each = np.repeat(np.arange(len(end)), high - low)
            place = low[each] + np.arange(len(each)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
            found.append((end[each], self.end_length[place], self.end_owner[place]))
            state = self.out[self.fail[state]].astype(np.int64)
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
