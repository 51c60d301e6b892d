"""A small causal self-attention language model over subword ids, in numpy.

One attention head looks at the last ``SPAN`` input ids. Ids are embedded by row (frequent
ids have rows of their own, the others share rows by hash). The output is factored: a softmax
over classes, then a softmax over the members of the class. Frequent ids are dealt into classes
of ``MEMBERS`` neighbours in the order of their bytes; the others are classed by whether they
start a word and by their first letter, and take their share of the class in the training
corpus. All ids together have probability 1.

A text is cut into chunks of ``SPAN`` positions; a window is a chunk with the one before it,
so windows overlap and each position is scored once, with its full span of context. All
windows of a batch go through masked attention together.
"""

from __future__ import annotations

import numpy as np

SPAN = 16
WIDTH = 16
OWN_ROWS, SHARED_ROWS = 1023, 1024
CLASSES, MEMBERS = 64, 32
#: First letters that tell tail classes apart: a-z, digits, beyond ASCII, others.
TAIL_LETTERS = 29
#: Learning rate of AdaGrad and chunks of a step.
RATE, STEP_CHUNKS = 0.3, 128
#: Chunks whose windows go through attention together when scoring.
SLICE_CHUNKS = 512

# window mask: query q of a chunk sees keys q+1 .. q+SPAN of the window (its own input last)
_Q, _K = np.arange(SPAN)[:, None], np.arange(2 * SPAN)[None, :]
_DISTANCE = SPAN + _Q - _K
_SEEN = (_DISTANCE >= 0) & (_DISTANCE < SPAN)
_REL = np.where(_SEEN, _DISTANCE, 0)


class Layout:
    """Classes and rows of ids from the corpus counts, and log-shares of ids in their class."""

    def __init__(self, counts: np.ndarray, bytes_of: list[bytes], end: int):
        n = len(counts)
        order = np.lexsort((np.arange(n), -counts))
        order = np.concatenate([[end], order[order != end]])  # the end of a text is always a class of its own
        self.row = np.empty(n, np.int32)
        self.row[order[:OWN_ROWS]] = np.arange(min(n, OWN_ROWS))
        rest = order[OWN_ROWS:]
        self.row[rest] = OWN_ROWS + (rest * 2654435761 % 2**32 * SHARED_ROWS >> 32)
        self.kind, self.member = np.empty(n, np.int32), np.zeros(n, np.int32)
        modelled = sorted(order[: CLASSES * MEMBERS].tolist(), key=lambda i: bytes_of[i].lower())
        self.kind[modelled] = np.arange(len(modelled)) // MEMBERS
        self.member[modelled] = np.arange(len(modelled)) % MEMBERS
        for i in order[CLASSES * MEMBERS :].tolist():
            b = bytes_of[i]
            starts, first = b[:1] == b" ", (b.lstrip(b" ").lower() or b" ")[0]
            letter = first - 97 if 97 <= first < 123 else 26 if 48 <= first < 58 else 27 if first >= 128 else 28
            self.kind[i] = CLASSES + TAIL_LETTERS * starts + letter
        self.n_rows, self.n_classes = OWN_ROWS + SHARED_ROWS, CLASSES + 2 * TAIL_LETTERS
        mass = counts + 0.1
        per_class = np.bincount(self.kind, weights=mass, minlength=self.n_classes)
        self.share_log = np.log(mass / per_class[self.kind]).astype(np.float32)
        self.class_log = np.log(np.maximum(per_class, 1e-9) / per_class.sum()).astype(np.float32)
        self.member_log = np.full((CLASSES, MEMBERS), -20, np.float32)
        self.member_log[self.kind[modelled], self.member[modelled]] = self.share_log[modelled]


def shapes(layout: Layout) -> list[tuple[str, tuple[int, ...]]]:
    d = WIDTH
    return [("E", (layout.n_rows, d)), ("Wq", (d, d)), ("Wk", (d, d)), ("Wv", (d, d)), ("Wo", (d, d)), ("rel", (SPAN,)), ("W", (d, d)), ("U", (d, layout.n_classes)), ("b", (layout.n_classes,)), ("M", (CLASSES, d, MEMBERS)), ("c", (CLASSES, MEMBERS))]


def initial(layout: Layout) -> np.ndarray:
    rng = np.random.default_rng(1)
    parts = []
    for name, shape in shapes(layout):
        if name == "b":
            parts.append(layout.class_log)
        elif name == "c":
            parts.append(layout.member_log)
        elif name == "rel":
            parts.append(np.zeros(shape))
        else:
            parts.append(rng.normal(0, 0.02 if name in "UM" else 0.25, shape))
    return np.concatenate([p.ravel() for p in parts]).astype(np.float32)


def unpack(flat: np.ndarray, layout: Layout) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(layout):
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape)
        at += size
    return out


def _by_class(kind: np.ndarray):
    """(class, places) of every class that occurs."""
    order = np.argsort(kind, kind="stable")
    cut = np.flatnonzero(np.diff(kind[order])) + 1
    for part in np.split(order, cut):
        if len(part):
            yield int(kind[part[0]]), part


def _in_classes(kind: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Places of modelled ids, class by class, and (class, begin, end) of those that occur."""
    order = np.argsort(kind.astype(np.uint8), kind="stable")
    edges = np.searchsorted(kind[order], np.arange(CLASSES + 1))
    return order[: edges[-1]], [(c, a, b) for c, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())) if a < b]


class Model:
    def __init__(self, flat: np.ndarray, layout: Layout):
        self.p, self.layout, self.flat = unpack(flat, layout), layout, flat
        self.cells = np.arange(layout.n_rows * WIDTH).reshape(-1, WIDTH)

    def id_logs(self, rows, has_before, ids: np.ndarray) -> np.ndarray:
        """log P(id) of the target of every position (flat) of successive chunks.

        The first chunk's predecessor, where it has one, comes as one more row in front.
        """
        p, layout, n = self.p, self.layout, len(has_before)
        rows = rows if len(rows) > n else np.concatenate([rows[:1], rows])
        kind = layout.kind[ids]
        h, out = np.empty((n * SPAN, WIDTH), np.float32), np.empty(n * SPAN, np.float32)
        for k in range(0, n, SLICE_CHUNKS):
            t = slice(k * SPAN, min(k + SLICE_CHUNKS, n) * SPAN)
            h[t] = self._hidden(rows[k : k + SLICE_CHUNKS + 1], has_before[k : k + SLICE_CHUNKS])
            z = h[t] @ p["U"]
            z += p["b"]
            out[t] = z[np.arange(len(z)), kind[t]]
            out[t] -= np.log(np.exp(z, out=z).sum(axis=1))  # logits are small: tanh units and bounded steps
        for k, at in _by_class(kind):
            if k < CLASSES:
                m = h[at] @ p["M"][k]
                m += p["c"][k]
                target = m[np.arange(len(at)), layout.member[ids[at]]]
                out[at] += target - np.log(np.exp(m, out=m).sum(axis=1))
            else:
                out[at] += layout.share_log[ids[at]]
        return out

    def _hidden(self, rows, has_before) -> np.ndarray:
        """Hidden values of successive chunks; rows[0] is the chunk before the first."""
        p, B = self.p, len(has_before)
        flat = p["E"][rows].reshape(-1, WIDTH)
        own = flat[SPAN:]
        kv = (flat @ np.concatenate([p["Wk"], p["Wv"]], axis=1)).reshape(B + 1, SPAN, 2 * WIDTH)
        kv = np.concatenate([kv[:-1], kv[1:]], axis=1)  # each chunk with the one before it
        q = (own @ (p["Wq"] * np.float32(WIDTH**-0.5))).reshape(B, SPAN, WIDTH)
        a = q @ kv[:, :, :WIDTH].transpose(0, 2, 1)
        a += np.where(_SEEN, p["rel"][_REL], np.float32(-1e9))
        if a.max() > 60:  # else the exponentials are safe as they are
            a -= a.max(axis=2, keepdims=True)
        np.exp(a, out=a)
        a[~has_before, :, :SPAN] = 0
        o = (a @ kv[:, :, WIDTH:]).reshape(-1, WIDTH)
        o /= (a @ np.ones(2 * SPAN, np.float32)).reshape(-1, 1)
        h = own @ p["W"]
        h += o @ p["Wo"]
        return np.tanh(h, out=h)

    def step(self, rows, before, has_before, ids, real, state: np.ndarray) -> float:
        """One AdaGrad step on the real positions of some chunks; the mean loss before it.

        ``before``: input rows of the chunk before each; used where ``has_before``.
        """
        p, layout, B, n = self.p, self.layout, len(rows), len(ids)
        scale, both = np.float32(WIDTH**-0.5), np.concatenate([p["Wk"], p["Wv"]], axis=1)
        given = np.concatenate([before, rows], axis=1)
        x = p["E"].take(given.ravel(), axis=0)
        kv = (x @ both).reshape(B, 2 * SPAN, 2 * WIDTH)
        k, v = np.ascontiguousarray(kv[:, :, :WIDTH]), np.ascontiguousarray(kv[:, :, WIDTH:])
        own = np.ascontiguousarray(x.reshape(B, 2 * SPAN, WIDTH)[:, SPAN:]).reshape(-1, WIDTH)
        q = (own @ (p["Wq"] * scale)).reshape(B, SPAN, WIDTH)
        a = q @ k.transpose(0, 2, 1)
        a += np.where(_SEEN, p["rel"][_REL], np.float32(-1e9))
        a[~has_before, :, :SPAN] = -1e9
        if a.max() > 60:  # else the exponentials are safe as they are
            a -= a.max(axis=2, keepdims=True)
        np.exp(a, out=a)
        a *= 1 / (a @ np.ones((2 * SPAN, 1), np.float32))
        o = (a @ v).reshape(-1, WIDTH)
        h = np.ones((n, WIDTH + 1), np.float32)  # the last column goes with the intercepts
        np.tanh(own @ p["W"] + o @ p["Wo"], out=h[:, :WIDTH])
        kind, weight = layout.kind[ids], (real / max(1, real.sum())).astype(np.float32)
        # classes
        z = h @ np.concatenate([p["U"], p["b"][None]])
        at = np.arange(n)
        logs = z[at, kind]
        np.exp(z, out=z)  # logits are small: tanh units and bounded steps
        total = z @ np.ones(z.shape[1], np.float32)
        logs -= np.log(total)
        z *= (weight / total)[:, None]
        z[at, kind] -= weight
        both_u = h.T @ z
        g = {"U": both_u[:-1], "b": both_u[-1]}
        dh = z @ p["U"].T
        # members: the positions of a class one after the other
        tail = kind >= CLASSES
        logs[tail] += layout.share_log[ids[tail]]
        places, classes = _in_classes(kind)
        inner, at, goal, share = h.take(places, axis=0), np.arange(len(places)), layout.member[ids[places]], weight[places]
        m, both_m = np.empty((len(places), MEMBERS), np.float32), np.concatenate([p["M"], p["c"][:, None]], axis=1)
        for c, i, j in classes:
            np.matmul(inner[i:j], both_m[c], out=m[i:j])
        of_goal = m[at, goal]
        np.exp(m, out=m)
        total = m @ np.ones(MEMBERS, np.float32)
        logs[places] += of_goal - np.log(total)
        m *= (share / total)[:, None]
        m[at, goal] -= share
        g_m, back = np.zeros_like(both_m), np.empty((len(places), WIDTH), np.float32)
        for c, i, j in classes:
            np.matmul(inner[i:j].T, m[i:j], out=g_m[c])
            np.matmul(m[i:j], p["M"][c].T, out=back[i:j])
        g["M"], g["c"] = g_m[:, :-1], g_m[:, -1]
        dh[places] += back
        loss = -logs[real].mean()
        dh *= 1 - h[:, :WIDTH] * h[:, :WIDTH]
        g["W"], g["Wo"] = own.T @ dh, o.T @ dh
        do = (dh @ p["Wo"].T).reshape(B, SPAN, WIDTH)
        da = do @ v.transpose(0, 2, 1)
        dkv = np.empty_like(kv)
        np.matmul(a.transpose(0, 2, 1), do, out=dkv[:, :, WIDTH:])
        da -= (do * o.reshape(do.shape)) @ np.ones((WIDTH, 1), np.float32)  # the row's sum of da * a
        da *= a
        g["rel"] = np.bincount(_REL[_SEEN], weights=da.sum(axis=0)[_SEEN], minlength=SPAN)
        np.matmul(da.transpose(0, 2, 1), q, out=dkv[:, :, :WIDTH])
        dq = (da @ k).reshape(-1, WIDTH)
        dq *= scale
        dkv = dkv.reshape(-1, 2 * WIDTH)
        g["Wq"], dboth = own.T @ dq, x.T @ dkv
        g["Wk"], g["Wv"] = dboth[:, :WIDTH], dboth[:, WIDTH:]
        dx = (dkv @ both.T).reshape(B, 2 * SPAN, WIDTH)
        dx[:, SPAN:] += (dh @ p["W"].T + dq @ p["Wq"].T).reshape(B, SPAN, WIDTH)
        g["E"] = np.bincount(self.cells.take(given.ravel(), axis=0).ravel(), weights=dx.ravel(), minlength=p["E"].size)
        gradient = np.concatenate([g[name].ravel() for name, _ in shapes(layout)], dtype=np.float32, casting="same_kind")
        state += gradient * gradient
        gradient *= RATE
        gradient /= np.sqrt(state)
        self.flat -= gradient
        return float(loss)


def chunks_of(ids: np.ndarray, bounds: np.ndarray, layout: Layout, end: int):
    """Chunks of texts (ids one after the other, each text closed by ``end``).

    Returns input rows (B, SPAN), rows of the chunk before, whether there is one, target ids
    (flat), which positions are real, and the positions of ``ids`` and of the texts' ends.
    """
    lengths = np.diff(bounds) + 1  # with the end
    n_chunks = -(-lengths // SPAN)
    begin = np.concatenate([[0], np.cumsum(n_chunks)])
    total = int(begin[-1]) * SPAN
    target = np.full(total, end, np.int64)
    start = begin[:-1] * SPAN
    place = np.arange(len(ids)) + np.repeat(start - bounds[:-1], np.diff(bounds))
    target[place] = ids
    given = np.full(total, end, np.int64)  # a text starts after an end
    given[1:] = target[:-1]
    given[start] = end
    real = np.zeros(total, bool)
    real[place] = True
    real[start + lengths - 1] = True
    rows = layout.row[given].reshape(-1, SPAN)
    has = np.ones(len(rows), bool)
    has[begin[:-1]] = False
    before = np.empty_like(rows)
    before[1:] = rows[:-1]
    before[:1] = 0
    return rows, before, has, target, real, place, start + lengths - 1
