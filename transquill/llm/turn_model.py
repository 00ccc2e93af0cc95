"""A semi-Markov conditional model of speaker turns: its scores of whole turns, its best sequence, and how it is fitted.

A turn is a run of pieces of one person. Its score sums, over its pieces, whether their labels can name the person; between
its pieces, the pauses, the lexical continuity and unfinished sentences; at its beginning, the same three across the change
of person and whether the first piece has a label; and it has a term for its length in pieces, which no sum over pieces can
give. Weights maximise the conditional likelihood of the turns of labelled files, with a Gaussian prior around 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: What the weights stand for, in order.
FITS, CLASHES, UNLABELLED, PAUSE_WITHIN, WORDS_WITHIN, OPEN_WITHIN, PAUSE_ACROSS, WORDS_ACROSS, OPEN_ACROSS, NO_LABEL_ACROSS, TURN, TWO, FEW, SOME, MANY = range(15)
#: Weights where there is no labelled file to fit them on.
UNFITTED = np.array([6.0, -12.0, 1.0, -0.3, 0.5, 0.5, 0.3, -0.5, -0.5, -6.0, -0.5, 0.0, 0.0, 0.0, 0.0])
#: The longest lengths of the terms of length: 1, 2, 3 to 4, 5 to 8, more.
LENGTHS = (1, 2, 4, 8)
#: Variance of the prior, steps and rate of the fit.
VARIANCE, STEPS, RATE = 25.0, 60, 0.5


@dataclass
class Sequence:
    """Pieces as numbers: fits[j][k] is 1, -1 or 0 where piece j's label can name person k, cannot, or is missing; pause, words and open lie between j - 1 and j."""

    fits: list[list[int]]
    pause: list[float]
    words: list[float]
    open: list[float]
    gold: list[int] | None = None


def overlap(a: set[str], b: set[str]) -> float:
    return len(a & b) / min(len(a), len(b)) if a and b else 0.0


def others_best(scores: list[float], k: int) -> int:
    """The highest of the others, of equals the first; -1 if there is no other."""
    best = -1
    for o, x in enumerate(scores):
        if o != k and (best < 0 or x > scores[best]):
            best = o
    return best


def best_persons(s: Sequence, w: list[float], persons: int) -> list[int]:
    """The person of each piece in the best sequence of turns: every length of every turn counts, in time linear in the pieces."""
    n, every, low = len(s.fits), range(persons), -1e18
    of_label = {1: w[FITS], -1: w[CLASHES], 0: w[UNLABELLED]}
    of_length = [0.0, w[TWO], w[FEW], w[FEW], w[SOME], w[SOME], w[SOME], w[SOME]]
    within, sums = 0.0, [0.0] * persons
    value: list[list[float]] = []  # value[i][k]: the best before i with a turn of k from i on, less the sums up to i
    long = [(low, 0)] * persons  # the best beginning of a turn of more than eight pieces
    best: list[list[float]] = []
    began: list[list[int]] = []
    for j in range(n):
        if j:
            within += w[PAUSE_WITHIN] * s.pause[j] + w[WORDS_WITHIN] * s.words[j] + w[OPEN_WITHIN] * s.open[j]
            change = w[TURN] + w[PAUSE_ACROSS] * s.pause[j] + w[WORDS_ACROSS] * s.words[j] + w[OPEN_ACROSS] * s.open[j] + (0.0 if any(s.fits[j]) else w[NO_LABEL_ACROSS])
            last = best[-1]
            top = max(every, key=last.__getitem__)
            next_ = others_best(last, top)
            enter = [change + (last[top] if k != top else last[next_] if next_ >= 0 else low) for k in every]
        else:
            enter = [w[TURN]] * persons
        value.append([e - x - within for e, x in zip(enter, sums)])
        sums = [x + of_label[f] for x, f in zip(sums, s.fits[j])]
        if j >= 8:
            long = [max(old, (v, j - 8), key=lambda x: x[0]) for old, v in zip(long, value[j - 8])]
        now, at = [], []
        for k in every:
            top_value, start = long[k][0] + w[MANY], long[k][1]
            for length, v in enumerate(reversed(value[max(0, j - 7) :])):
                if (x := v[k] + of_length[length]) >= top_value:
                    top_value, start = x, j - length
            now.append(top_value + sums[k] + within)
            at.append(start)
        best.append(now)
        began.append(at)
    out = [0] * n
    j = n - 1
    k = max(every, key=best[j].__getitem__) if n else 0
    while j >= 0:
        i = began[j][k]
        out[i : j + 1] = [k] * (j + 1 - i)
        j = i - 1
        if j >= 0:
            k = others_best(best[j], k)
    return out


def score(s: Sequence, w: list[float], who: list[int]) -> float:
    """The score of a sequence of turns."""
    total, length = 0.0, 0
    for j, k in enumerate(who):
        total += {1: w[FITS], -1: w[CLASHES], 0: w[UNLABELLED]}[s.fits[j][k]]
        if j and who[j - 1] == k:
            total += w[PAUSE_WITHIN] * s.pause[j] + w[WORDS_WITHIN] * s.words[j] + w[OPEN_WITHIN] * s.open[j]
            length += 1
        else:
            total += w[TURN]
            if j:
                total += w[PAUSE_ACROSS] * s.pause[j] + w[WORDS_ACROSS] * s.words[j] + w[OPEN_ACROSS] * s.open[j] + (0.0 if any(s.fits[j]) else w[NO_LABEL_ACROSS])
            length = 1
        if j + 1 == len(who) or who[j + 1] != k:
            total += 0.0 if length == 1 else w[TWO] if length == 2 else w[FEW] if length <= 4 else w[SOME] if length <= 8 else w[MANY]
    return total


def fit(sequences: list[Sequence], persons: int) -> list[float]:
    """Weights of the greatest conditional likelihood of the sequences' gold persons; all sequences go through each step at once."""
    own = [s for s in sequences if s.gold and len(s.fits) >= 2]
    if len(own) < 4:
        return UNFITTED.tolist()
    f, n = len(own), max(len(s.fits) for s in own)
    fits, real = np.zeros((f, n, persons)), np.zeros((f, persons), bool)
    gaps = np.zeros((f, n, 3))
    size, gold = np.array([len(s.fits) for s in own]), np.full((f, n), -1)
    for i, s in enumerate(own):
        m = len(s.fits)
        fits[i, :m, : len(s.fits[0])] = s.fits
        real[i, : len(s.fits[0])] = True
        gaps[i, :m] = np.stack([s.pause, s.words, s.open], 1)
        gold[i, :m] = s.gold
    there = np.arange(n) < size[:, None]
    bare = ~(fits != 0).any(axis=2)
    labels = np.stack([fits == 1, fits == -1, fits == 0], 3) & there[:, :, None, None]  # file, piece, person, label's fit
    of_length = np.array([0, 1, 2, 2, 3, 3, 3, 3] + [4] * max(0, n - 8))[:n]
    across = np.concatenate([gaps, bare[:, :, None]], 2)
    across[:, 0] = 0.0
    gaps = gaps * there[:, :, None]
    gaps[:, 0] = 0.0

    def expect(w: np.ndarray) -> tuple[float, np.ndarray]:
        """(sum of log partition functions, expected features), by the forward and the backward sums."""
        piece = np.cumsum(np.concatenate([np.zeros((f, 1, persons)), labels @ w[:3]], 1), 1)
        inner = np.cumsum(gaps @ w[3:6], 1)
        change = w[TURN] + across @ w[6:10]
        length = np.concatenate([[0.0], w[TWO:]])[of_length]
        low = -1e9
        shut = np.where(real, 0.0, low)[:, None, :]
        enter, alpha = np.full((f, n, persons), low), np.full((f, n, persons), low)
        log_sum = lambda x, axis: (m := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis))

        def of_others(x: np.ndarray) -> np.ndarray:
            """For each person the log sum over the others."""
            m = x.max(axis=1, keepdims=True)
            e = np.exp(x - m)
            return m + np.log(np.maximum(e.sum(axis=1, keepdims=True) - e, 1e-300))

        enter[:, 0] = w[TURN] + shut[:, 0]
        for j in range(n):
            if j:
                enter[:, j] = of_others(alpha[:, j - 1]) + change[:, j, None] + shut[:, 0]
            lengths = length[j::-1] if j else length[:1]
            alpha[:, j] = log_sum(enter[:, : j + 1] - piece[:, : j + 1] - inner[:, : j + 1, None] + lengths[None, :, None], 1) + piece[:, j + 1] + inner[:, j, None]
        z = log_sum(alpha[np.arange(f), size - 1], 1)
        beta, gamma = np.full((f, n, persons), low), np.full((f, n, persons), low)
        for j in range(n - 1, -1, -1):
            beta[:, j] = np.where((size - 1 == j)[:, None], 0.0, (of_others(gamma[:, j + 1]) + change[:, j + 1, None]) if j + 1 < n else low)
            beta[~there[:, j], j] = low
            gamma[:, j] = log_sum(beta[:, j:] + piece[:, j + 1 :] + inner[:, j:, None] + length[None, : n - j, None], 1) - piece[:, j] - inner[:, j, None] + shut[:, 0]
        counts = np.zeros(15)
        begins, ends, covers = np.zeros((f, n)), np.zeros((f, n + 1, persons)), np.zeros((f, n + 1, persons))
        for j in range(n):  # turns that end with piece j
            lengths = length[j::-1] if j else length[:1]
            p = np.exp(np.minimum(enter[:, : j + 1] - piece[:, : j + 1] - inner[:, : j + 1, None] + lengths[None, :, None] + (piece[:, j + 1] + inner[:, j, None] + beta[:, j])[:, None] - z[:, None, None], 0.0))
            begins[:, : j + 1] += p.sum(axis=2)
            covers[:, : j + 1] += p
            ends[:, j + 1] += p.sum(axis=1)
            counts[10:] += np.bincount(of_length[j::-1] if j else of_length[:1], weights=p.sum(axis=(0, 2)), minlength=5)
        counts[TURN] = begins[there].sum()
        on = np.cumsum(covers - ends, 1)[:, :n]  # how likely each piece is each person's
        counts[:3] = np.einsum("fnk,fnkl->l", on, labels)
        begins[:, 0] = 0.0
        counts[6:10] = np.einsum("fn,fnx->x", begins * there, across)
        counts[3:6] = np.einsum("fn,fnx->x", there * (1 - begins), gaps)
        return float(z.sum()), counts

    seen = np.zeros(15)
    begins = (np.diff(gold, axis=1, prepend=-2) != 0) & there
    seen[TURN] = begins.sum()
    seen[:3] = labels[np.arange(f)[:, None], np.arange(n), np.maximum(gold, 0)].sum(axis=(0, 1))
    later = begins.copy()
    later[:, 0] = False
    seen[6:10] = np.einsum("fn,fnx->x", later, across)
    seen[3:6] = np.einsum("fn,fnx->x", there & ~later, gaps)
    for i in range(f):
        starts = np.flatnonzero(begins[i])
        for m in np.diff([*starts, size[i]]):
            if of_length[m - 1]:
                seen[TURN + of_length[m - 1]] += 1
    w, step, slow, fast = np.zeros(15), 0, np.zeros(15), np.zeros(15)
    for step in range(1, STEPS + 1):  # steps that follow the mean and the spread of the gradient
        gradient = (seen - expect(w)[1]) / f - w / (VARIANCE * f)
        slow, fast = 0.9 * slow + 0.1 * gradient, 0.99 * fast + 0.01 * gradient**2
        w = w + RATE * (slow / (1 - 0.9**step)) / (np.sqrt(fast / (1 - 0.99**step)) + 1e-8)
    return w.tolist()
