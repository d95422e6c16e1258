"""A gated recurrent language model in numpy.

The output is factored by class: the most frequent tokens, the end of the text
among them, are ranked into classes of ``WIDTH``, and a softmax over the words
of the class follows the softmax over all classes.  Every other token belongs
to one of ``TAIL`` classes by the last bytes of its stem; within such a class
its probability is that of a smoothed unigram, which is not the network's
business.  Input gates are looked up per token (embedding and input weights in
one table).

Training is truncated backpropagation through windows of ``STEPS`` tokens; the
state is carried from window to window and set to zero where a text begins.
A text of more than ``PIECE`` tokens is learned in pieces, side by side; a later
piece starts from the state that the ``WARM`` tokens before it leave behind.
Scoring carries the state the same way, so a text's log-likelihood is that of
the complete text.  Texts are dealt to lanes, which run side by side; lanes
are sorted by length, so those that have ended drop out.
"""

from __future__ import annotations

import zlib

import numpy as np

HIDDEN = 16
SHORTLIST = 1024
WIDTH = 32
TAIL = 32
STEPS = 16
LANES = 512
#: The same for scoring, where a window is only a unit of work.
SCORE_STEPS, SCORE_LANES = 16, 512
#: Tokens whose class probabilities are worked out at a time (they stay near the core).
NEAR = 2048
#: In training, longer texts are dealt to lanes in pieces of so many tokens;
#: tokens that are read before a later piece, for its state.
PIECE, WARM = 2048, 64
#: Tokens dealt to lanes at a time (a longer text stands alone).
CHUNK = 2_000_000
END = 0
PUNCTUATION = b".,!?;:|%$&*#\"'()"

#: Sizes that follow.
CLASSES = SHORTLIST // WIDTH + TAIL
START = SHORTLIST + TAIL  # as an input only
SHAPES = {
    "gates": (START + 1, 3 * HIDDEN),
    "state": (HIDDEN, 3 * HIDDEN),
    "class_w": (HIDDEN, CLASSES),
    "class_b": (CLASSES,),
    "word_w": (SHORTLIST, HIDDEN),
    "word_b": (SHORTLIST,),
}


def tail_class(token: bytes) -> int:
    return zlib.crc32(token.rstrip(PUNCTUATION)[-2:]) % TAIL


def initial(short_counts: np.ndarray, tail_counts: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters whose output is the unigram model: the biases are the logs of
    the (smoothed) counts of the shortlist (padded with zeros) and the tails."""
    rng = np.random.default_rng(seed)
    p = {k: (0.08 * rng.standard_normal(s)).astype(np.float32) for k, s in SHAPES.items()}
    short = np.zeros(SHORTLIST)
    short[: len(short_counts)] = short_counts
    by_class = np.concatenate([(short + 0.01).reshape(-1, WIDTH).sum(axis=1), tail_counts + 0.5])
    p["class_b"] = np.log(by_class / by_class.sum()).astype(np.float32)
    p["word_b"] = np.log(short + 0.01).astype(np.float32)
    p["class_w"] *= 0.1
    p["word_w"] *= 0.1
    return p


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES]).astype(np.float32)


def unflat(v: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = v[at : at + n].reshape(s).copy()
        at += n
    return out


class Lanes:
    """Texts (arrays of codes, each ending with ``END``) dealt to lanes, held
    one after another; only a window's steps are laid side by side, so a long
    text costs its own length, not that of all lanes."""

    def __init__(self, texts: list[np.ndarray], lanes: int, before: np.ndarray | None = None):
        """``before``: what was read before each text (default: nothing)."""
        self.n = len(texts)
        lengths = np.array([len(t) for t in texts])
        lanes = max(1, min(lanes, len(texts)))
        load = np.zeros(lanes, np.int64)
        held: list[list[int]] = [[] for _ in range(lanes)]
        # The longest first, each to the emptiest lane.
        import heapq

        heap = [(0, j) for j in range(lanes)]
        for i in np.argsort(-lengths, kind="stable").tolist():
            size, j = heapq.heappop(heap)
            held[j].append(i)
            load[j] = size + lengths[i]
            heapq.heappush(heap, (int(load[j]), j))
        order = np.argsort(-load, kind="stable")
        self.load = load[order]
        self.length = int(self.load[0])
        self.lanes = lanes
        self.first = np.cumsum(self.load) - self.load
        dealt = np.array([i for lane in order.tolist() for i in held[lane]], np.int64)
        self.codes = np.concatenate([texts[i] for i in dealt.tolist()]).astype(np.int32, copy=False)
        self.owner = np.repeat(dealt.astype(np.int32), lengths[dealt])
        self.given = np.roll(self.codes, 1)
        begins = np.cumsum(lengths[dealt]) - lengths[dealt]
        full = lengths[dealt] > 0
        self.given[begins[full]] = START if before is None else before[dealt][full]
        # Lane and step of the first token of every text.
        self.lane, self.begin = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        self.lane[dealt] = np.searchsorted(self.first, begins, side="right") - 1
        self.begin[dealt] = begins - self.first[self.lane[dealt]]

    def windows(self, steps: int, tokens: int = 0):
        """(first step, last step, lanes still running) of each window, which
        has more than ``steps`` where the lanes need them for ``tokens``."""
        a = 0
        while a < self.length:
            running = int(np.searchsorted(-self.load, -a, side="left"))
            b = min(a + max(steps, tokens // running), self.length)
            yield a, b, running
            a = b

    def window(self, a: int, b: int, running: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, targets and texts (-1: the lane has ended) of a window:
        (steps, lanes) each."""
        at = np.arange(a, b)[:, None]
        on = at < self.load[:running]
        at = np.where(on, self.first[:running] + at, 0)
        return np.where(on, self.given[at], START), np.where(on, self.codes[at], 0), np.where(on, self.owner[at], -1)


def _keep_memory() -> None:
    """Freeing a large piece once lets the allocator keep what a window frees
    for the next one, which else comes from the system again, page by page."""
    np.empty(8 << 20, np.uint8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def _thirds(p: dict[str, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The input and state weights of the gates z and r and of the proposed
    state, each in one piece in memory: arithmetic on whole arrays is faster."""
    parts = [slice(i * HIDDEN, (i + 1) * HIDDEN) for i in range(3)]
    return [(np.ascontiguousarray(p["gates"][:, at]), np.ascontiguousarray(p["state"][:, at])) for at in parts]


def _step(thirds: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray, h: np.ndarray):
    """The gates z and r, the proposed state, the part of it that r lets in or
    not, and the states after the inputs ``x``."""
    (gate_z, state_z), (gate_r, state_r), (gate_n, state_n) = thirds
    z, r, let = h @ state_z, h @ state_r, h @ state_n
    z += gate_z.take(x, axis=0)
    r += gate_r.take(x, axis=0)
    _sigmoid(z)
    _sigmoid(r)
    n = r * let
    n += gate_n.take(x, axis=0)
    np.tanh(n, out=n)
    after = h - n
    after *= z
    after += n
    return z, r, n, let, after


def _class_of(codes: np.ndarray) -> np.ndarray:
    return np.where(codes < SHORTLIST, codes // WIDTH, SHORTLIST // WIDTH + codes - SHORTLIST)


#: Products up to here can be exponentiated as they are.
SAFE = 60.0


def _flat(at: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The places of rows ``at``, one a column, in the flat ``x``."""
    return at * np.intp(x.shape[1]) + np.arange(x.shape[1])


def _log_total(x: np.ndarray, at: np.ndarray, shift: bool = True) -> np.ndarray:
    """Log-probability of class ``at`` of each token under the softmax over
    the columns of ``x`` (classes, tokens), which becomes its exponentials.
    ``shift``: unless no product is beyond ``SAFE``."""
    if shift:
        x -= x.max(axis=0)
    picked = x.take(_flat(at, x))
    np.exp(x, out=x)
    return picked - np.log(x.sum(axis=0))


def _shift(p: dict[str, np.ndarray]) -> bool:
    """Whether a product may be beyond ``SAFE``: states are within -1 and 1."""
    by_class = np.abs(p["class_w"]).sum(axis=0) + np.abs(p["class_b"])
    by_word = np.abs(p["word_w"]).sum(axis=1) + np.abs(p["word_b"])
    return not max(by_class.max(), by_word.max()) <= SAFE


def _softmax(x: np.ndarray, at: np.ndarray, shift: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The same, and all probabilities, less 1 at ``at``."""
    if shift:
        x -= x.max(axis=0)
    place = _flat(at, x)
    picked = x.take(place)
    np.exp(x, out=x)
    total = x.sum(axis=0)
    x /= total
    x.ravel()[place] -= 1
    return picked - np.log(total), x


def _by_class(codes: np.ndarray):
    """The rows of the shortlist targets, ordered by target, and (class, slice
    of them, place in the class) of each class."""
    short = np.flatnonzero((codes >= 0) & (codes < SHORTLIST))
    short = short[np.argsort(codes[short].astype(np.uint16), kind="stable")]  # 16 bits: a radix sort
    owner, place = np.divmod(codes[short], WIDTH)
    edges = np.searchsorted(owner, np.arange(SHORTLIST // WIDTH + 1)).tolist()
    return short, [(k, slice(a, b), place[a:b]) for k, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]


def score(p: dict[str, np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """Natural-log likelihood of each text (tail tokens: of their class)."""
    out = np.zeros(len(texts))
    if not texts:
        return out
    _keep_memory()
    lanes = Lanes(texts, SCORE_LANES)
    shift, thirds = _shift(p), _thirds(p)
    class_w, class_b = np.ascontiguousarray(p["class_w"].T), p["class_b"][:, None]
    h = np.zeros((lanes.lanes, HIDDEN), np.float32)
    for a, b, running in lanes.windows(SCORE_STEPS, SCORE_STEPS * SCORE_LANES):
        given, target, owner = lanes.window(a, b, running)
        states = np.empty((b - a, running, HIDDEN), np.float32)
        h = h[:running]
        for t in range(a, b):
            x = given[t - a]
            h[x == START] = 0
            h = _step(thirds, x, h)[-1]
            states[t - a] = h
        owner = owner.ravel()
        used = owner >= 0
        owner, codes = owner[used], target.ravel()[used]
        s = states.reshape(-1, HIDDEN)[used]
        found, kinds = np.empty(len(codes), np.float32), _class_of(codes)
        for lo in range(0, len(codes), NEAR):
            part = slice(lo, lo + NEAR)
            x = class_w @ s[part].T
            x += class_b
            found[part] = _log_total(x, kinds[part], shift)
        short, classes = _by_class(codes)
        s, inner = s[short], np.empty(len(short), np.float32)
        for k, at, place in classes:
            words = slice(k * WIDTH, (k + 1) * WIDTH)
            x = p["word_w"][words] @ s[at].T
            x += p["word_b"][words, None]
            inner[at] = _log_total(x, place, shift)
        found[short] += inner
        out += np.bincount(owner, weights=found, minlength=len(texts))
    return out


def states_after(p: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The states, from zero, after the inputs ``x`` (texts, steps)."""
    h = np.zeros((len(x), HIDDEN), np.float32)
    thirds = _thirds(p)
    for t in range(x.shape[1]):
        h = _step(thirds, x[:, t], h)[-1]
    return h


def gradients(p, x, target, valid, h, given: dict | None = None):
    """Loss (sum of natural logs), gradients of its mean, and the last state
    of a window: ``x``, ``target`` and ``valid`` are (steps, lanes).
    ``given``: step -> (lanes, states) that begin there."""
    steps, lanes = x.shape
    thirds, hs, kept, fresh = _thirds(p), [], [], []
    states = np.empty((steps, lanes, HIDDEN), h.dtype)
    for t in range(steps):
        begin = x[t] == START
        h = h.copy()
        if given and t in given:
            begin[given[t][0]] = True  # nothing flows back into the text before
        begin = np.flatnonzero(begin)
        h[begin] = 0
        if given and t in given:
            h[given[t][0]] = given[t][1]
        hs.append(h)
        *gates, h = _step(thirds, x[t], h)
        states[t] = h
        kept.append(gates)
        fresh.append(begin)
    s = states.reshape(-1, HIDDEN)
    codes, mask = target.ravel(), valid.ravel()
    count = max(1, int(mask.sum()))
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    owner, shift = _class_of(codes), _shift(p)
    weight = mask.astype(np.float32) / count
    d = p["class_w"].T @ s.T
    d += p["class_b"][:, None]
    logp, d = _softmax(d, owner, shift)
    d *= weight
    loss = float(logp[mask].sum())
    grad["class_w"], grad["class_b"] = (d @ s).T, d.sum(axis=1)
    ds = d.T @ p["class_w"].T
    short, classes = _by_class(np.where(mask, codes, -1))
    s = s[short]
    back = np.empty_like(s)
    for k, at, place in classes:
        words = slice(k * WIDTH, (k + 1) * WIDTH)
        e = p["word_w"][words] @ s[at].T
        e += p["word_b"][words, None]
        inner, e = _softmax(e, place, shift)
        loss += float(inner.sum())
        e /= count
        grad["word_w"][words], grad["word_b"][words] = e @ s[at], e.sum(axis=1)
        back[at] = e.T @ p["word_w"][words]
    ds[short] += back
    ds = ds.reshape(steps, lanes, HIDDEN)
    dh = np.zeros((lanes, HIDDEN), np.float32)
    dgates = np.empty((steps, lanes, 3 * HIDDEN), np.float32)
    du = np.empty((lanes, 3 * HIDDEN), s.dtype)
    back_w = p["state"].T
    for t in range(steps - 1, -1, -1):
        dh = dh + ds[t]
        (z, r, n, let), b = kept[t], hs[t]
        rest = 1 - z
        dn = dh * rest
        dn *= 1 - n * n
        dz = b - n
        dz *= dh
        dz *= z
        dz *= rest
        dr = dn * let
        dr *= r
        dr *= 1 - r
        du[:, :HIDDEN], du[:, HIDDEN : 2 * HIDDEN] = dz, dr
        dgates[t] = du
        dgates[t, :, 2 * HIDDEN :] = dn
        np.multiply(dn, r, out=du[:, 2 * HIDDEN :])
        grad["state"] += b.T @ du
        dh *= z
        dh += du @ back_w
        dh[fresh[t]] = 0
    order = np.argsort(x.ravel().astype(np.uint16), kind="stable")
    ids = x.ravel()[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    grad["gates"][ids[first]] = np.add.reduceat(dgates.reshape(-1, 3 * HIDDEN).take(order, axis=0), first, axis=0)
    return loss, grad, h


class Trainer:
    """Adam over chunks of texts, starting from given parameters."""

    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.step, self.tokens = p, rate, 0, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def learn(self, texts: list[np.ndarray]) -> float:
        """One pass over the texts; the mean log-likelihood of a token."""
        pieces, before, late, warm = [], [], [], []
        for t in texts:
            for a in range(0, len(t), PIECE):
                if a:
                    late.append(len(pieces))
                    warm.append(t[a - 1 - WARM : a - 1])
                before.append(t[a - 1] if a else START)
                pieces.append(t[a : a + PIECE])
        total = sum(map(len, pieces))
        if not total:
            return 0.0
        _keep_memory()
        # Fewer lanes for little data: more steps matter more than speed.
        lanes = Lanes(pieces, int(np.clip(total // (STEPS * 64), 8, LANES)), np.array(before, np.int32))
        late, warm = np.array(late, int), np.array(warm, np.int32).reshape(-1, WARM)
        h, loss = np.zeros((lanes.lanes, HIDDEN), np.float32), 0.0
        for a, b, running in lanes.windows(STEPS):
            here = (lanes.begin[late] >= a) & (lanes.begin[late] < b)
            given = {}
            if here.any():
                states = states_after(self.p, warm[here])
                step, lane = lanes.begin[late[here]] - a, lanes.lane[late[here]]
                given = {int(t): (lane[step == t], states[step == t]) for t in np.unique(step)}
            x, target, owner = lanes.window(a, b, running)
            got, grad, h = gradients(self.p, x, target, owner >= 0, h[:running], given)
            loss += got
            self._update(grad)
        self.tokens += total
        return loss / total

    def _update(self, grad: dict[str, np.ndarray]) -> None:
        self.step += 1
        scale = self.rate * np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step)
        for k, g in grad.items():
            np.clip(g, -1, 1, out=g)
            m, v = self.m[k], self.v[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            self.p[k] -= (scale * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
