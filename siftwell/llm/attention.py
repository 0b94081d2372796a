"""A small causal self-attention model in numpy, over compact subword ids.

One head looks back over at most ``CONTEXT`` tokens. A key is made of a token and the one before it, so that the head can find
where the last token occurred before; a learned bias by distance is added. The next token is either copied from where the head
looks, or drawn in two steps: its class by a softmax over what the head brings back, its place within the class by fixed
frequencies. A learned gate mixes the two. Class logits start from fixed biases, the smoothed log frequencies of classes after the
token before, over all training texts. Texts are scored in windows of ``CONTEXT`` tokens that overlap: the first
``CONTEXT - SCORED`` are context only, so every token is scored once, with at least ``CONTEXT - SCORED`` tokens before it.
"""

from __future__ import annotations

import numpy as np

DIM = 16
SCORED = 32
CONTEXT = 40
#: Classes and members of a class; class * MEMBERS + member is a compact id.
CLASSES, MEMBERS = 64, 64
TOKENS = CLASSES * MEMBERS
#: Compact ids: frequent subwords, then these three at the end of the table.
OTHER, END, START = TOKENS - 3, TOKENS - 2, TOKENS - 1
#: Steps of the stored logarithms of members: 16 bits reach from 0 to -21.
STEPS = 3000.0

SHAPES = {
    "embedding": (TOKENS, DIM),
    "query": (DIM, DIM),
    "key": (DIM, DIM),
    "key_before": (DIM, DIM),
    "value": (DIM, DIM),
    "own": (DIM, DIM),
    "distance": (CONTEXT,),
    "to_class": (DIM, CLASSES),
    "to_gate": (DIM,),
    "gate": (1,),
}


def factors(before: np.ndarray, after: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``DIM`` numbers for each token as one that is followed, and as one that follows: leading factors of the table of pairs."""
    pairs = np.zeros((TOKENS, TOKENS), np.float32)
    pairs[before, after] = counts
    pairs /= np.sqrt(pairs.sum(axis=1) + 1)[:, None]
    pairs /= np.sqrt(pairs.sum(axis=0) + 1)[None, :]
    basis = np.random.default_rng(11).standard_normal((TOKENS, 2 * DIM)).astype(np.float32)
    for _ in range(3):
        basis = np.linalg.qr(pairs.T @ (pairs @ basis))[0]
    left, sizes, right = np.linalg.svd(pairs @ basis, full_matrices=False)
    right = basis @ right.T

    def scaled(side):
        side = side[:, :DIM] * np.sqrt(sizes[:DIM])
        return (side / (np.linalg.norm(side, axis=1, keepdims=True) + 1e-9)).astype(np.float32)

    return scaled(left), scaled(right)


def balanced_classes(points: np.ndarray) -> np.ndarray:
    """A class for each point, ``MEMBERS`` points in each: groups are halved along their widest direction."""
    groups = [np.arange(len(points))]
    while len(groups) < CLASSES:
        halves = []
        for group in groups:
            own = points[group] - points[group].mean(axis=0)
            direction = np.linalg.eigh(own.T @ own)[1][:, -1]
            group = group[np.argsort(own @ direction, kind="stable")]
            halves += [group[: len(group) // 2], group[len(group) // 2 :]]
        groups = halves
    out = np.empty(len(points), np.int64)
    for number, group in enumerate(groups):
        out[group] = number
    return out


class Biases:
    """Frequencies after each token: of classes, [before, class], and of tokens within their class, [before * TOKENS + token].

    Bigrams are smoothed with unigrams, in proportion to the number of distinct followers (Witten and Bell).
    """

    def __init__(self, before: np.ndarray, after: np.ndarray, counts: np.ndarray):
        single = np.bincount(after, weights=counts, minlength=TOKENS) + 0.5
        single = (single / single.sum()).astype(np.float32)
        total = np.bincount(before, weights=counts, minlength=TOKENS).astype(np.float32)
        kinds = np.bincount(before, minlength=TOKENS).astype(np.float32)
        kinds[kinds == 0] = 1
        table = kinds[:, None] * single[None, :]
        table[before, after] += counts
        table /= (total + kinds)[:, None]
        # Tokens that follow the same tokens share a class.
        self.followed, self.follows = factors(before, after, counts)
        self.class_of = balanced_classes(self.follows)
        order = np.argsort(self.class_of, kind="stable")
        classes = table[:, order].reshape(TOKENS, CLASSES, MEMBERS).sum(axis=2)
        # By rows: ``take`` copies a whole table that lies otherwise.
        self.classes = np.ascontiguousarray(classes / classes.sum(axis=1, keepdims=True))
        table /= classes[:, self.class_of]
        np.log(table, out=table)
        table *= np.float32(-STEPS)
        np.rint(table, out=table)
        self.members = np.minimum(table, 65535, out=table).astype(np.uint16).reshape(-1)

    def within(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Probability of a token within its class."""
        return np.exp(self.members[before * TOKENS + token].astype(np.float32) * np.float32(-1 / STEPS))


def initial(biases: Biases | None = None) -> dict[str, np.ndarray]:
    """Embeddings from the factors of pairs, where there are any. The head starts by looking for the last token among those before
    a position, and is seldom believed."""
    chance = np.random.default_rng(7)
    params = {name: np.zeros(shape, np.float32) for name, shape in SHAPES.items()}
    params["embedding"] = chance.standard_normal((TOKENS, DIM)).astype(np.float32) * np.float32(0.5)
    if biases is not None:
        params["embedding"] = biases.followed + params["embedding"] * np.float32(0.4)
    for name in ("query", "key_before"):
        params[name] = np.eye(DIM, dtype=np.float32) * np.float32(1.5)
    for name in ("value", "own"):
        params[name] = chance.standard_normal((DIM, DIM)).astype(np.float32) * np.float32(0.25)
    params["to_class"] = chance.standard_normal((DIM, CLASSES)).astype(np.float32) * np.float32(0.02)
    params["gate"][:] = -4
    return params


def flatten(params: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([params[name].reshape(-1) for name in SHAPES])


def unflatten(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


#: [scored position, window position]: how far back it lies; positions that lie ahead are not seen.
_BACK = (np.arange(SCORED)[:, None] + CONTEXT - SCORED) - np.arange(CONTEXT)[None, :]
_SEEN = _BACK >= 0
_BACK = np.where(_SEEN, _BACK, 0)


def layout(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text of each window of a chunk, and its number within the text."""
    rows = -(-np.diff(edges) // SCORED)
    owner = np.repeat(np.arange(len(rows)), rows)
    return owner, np.arange(len(owner)) - (np.cumsum(rows) - rows)[owner]


def cut_windows(ids: np.ndarray, edges: np.ndarray, owner: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Rows of CONTEXT + 1 ids for these windows; the last SCORED of a row are its targets, each predicted from the ids before it."""
    # Window r of a text has the targets r * SCORED .. and the CONTEXT + 1 - SCORED ids before them.
    place = number[:, None] * SCORED + np.arange(CONTEXT + 1) - (CONTEXT + 1 - SCORED)
    inside = (place >= 0) & (place < np.diff(edges)[owner][:, None])
    flat = np.where(inside, place + edges[:-1][owner][:, None], 0)
    return np.where(inside, ids[flat] if len(ids) else 0, START).astype(np.int16)


def text_windows(ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts of a chunk, the text of each, and how many of its targets are real."""
    owner, number = layout(edges)
    return cut_windows(ids, edges, owner, number), owner, np.minimum(SCORED, np.diff(edges)[owner] - number * SCORED)


class Room:
    """Arrays by name that one batch after the other uses, so that no batch asks the system for memory anew."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int, kind=np.float32) -> np.ndarray:
        size = int(np.prod(shape))
        if name not in self.held or len(self.held[name]) < size:
            self.held[name] = np.empty(size, kind)
        return self.held[name][:size].reshape(shape)


def _exponentials(x: np.ndarray, out: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """exp(x), by row in proportion, and the sums of rows; multiplied by ``times`` where given. ``x`` may be overwritten.

    The largest of a row is only taken off where sums would not be sound without it.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        np.exp(x, out=out)
        if times is not None:
            out *= times
        sums = out.reshape(-1, x.shape[-1]) @ np.ones(x.shape[-1], np.float32)
    if not (np.isfinite(sums).all() and sums.min(initial=1) > 1e-20):
        if times is not None:
            x += np.log(times + np.float32(1e-30))
        x -= x.max(axis=-1, keepdims=True)
        np.exp(x, out=out)
        sums = out.reshape(-1, x.shape[-1]).sum(axis=1)
    return out, sums.reshape(x.shape[:-1])


class Pass:
    """What a batch of windows gives on the way forward; ``chance`` is the probability of each target, [row, SCORED].

    Its arrays lie in ``room`` and hold until the next pass there.
    """

    def __init__(self, params: dict[str, np.ndarray], biases: Biases, rows: np.ndarray, room: Room):
        rows, n = rows.astype(np.int16, copy=False), len(rows)
        self.inputs = rows[:, :CONTEXT].astype(np.intp)
        self.target = rows[:, CONTEXT + 1 - SCORED :].astype(np.intp)
        before = self.inputs[:, CONTEXT - SCORED :]

        def times(name: str, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            return np.matmul(left, right, out=room(name, len(left), right.shape[1]))

        # Indices are sound; other modes than "raise" write to ``out`` directly.
        x = params["embedding"].take(self.inputs.reshape(-1), axis=0, out=room("x", n * CONTEXT, DIM), mode="clip")
        self.x = x.reshape(n, CONTEXT, DIM)
        self.last = room("last", n, SCORED, DIM)
        self.last[:] = self.x[:, CONTEXT - SCORED :]
        last = self.last.reshape(-1, DIM)
        self.q = times("q", last, params["query"] * np.float32(DIM**-0.5)).reshape(n, SCORED, DIM)
        self.k = times("k", x, params["key"]).reshape(n, CONTEXT, DIM)
        self.k[:, 1:] += times("moved", x, params["key_before"]).reshape(n, CONTEXT, DIM)[:, :-1]
        self.v = times("v", x, params["value"]).reshape(n, CONTEXT, DIM)
        turned = room("turned", n, DIM, CONTEXT)
        turned[:] = self.k.transpose(0, 2, 1)
        scores = np.matmul(self.q, turned, out=room("scores", n, SCORED, CONTEXT))
        scores += np.where(_SEEN, params["distance"][_BACK], np.float32(-1e9))
        # Weights by row in proportion; ``share`` makes them add up to one.
        self.weights, sums = _exponentials(scores, room("weights", n, SCORED, CONTEXT))
        self.share = 1 / sums
        self.hidden = np.matmul(self.weights, self.v, out=room("hidden", n, SCORED, DIM))
        self.hidden *= self.share[:, :, None]
        self.hidden += times("own", last, params["own"]).reshape(n, SCORED, DIM)
        np.tanh(self.hidden, out=self.hidden)
        flat = self.hidden.reshape(-1, DIM)
        prior = biases.classes.take(before.reshape(-1), axis=0, out=room("prior", n * SCORED, CLASSES), mode="clip")
        self.classes, self.sums = _exponentials(
            times("logits", flat, params["to_class"]), room("classes", n * SCORED, CLASSES), prior
        )
        self.at = np.arange(self.target.size) * CLASSES + biases.class_of.take(self.target.reshape(-1))
        of_class = (self.classes.reshape(-1).take(self.at) / self.sums).reshape(self.target.shape)
        self.gate = 1 / (1 + np.exp(-(flat @ params["to_gate"] + params["gate"]))).reshape(self.target.shape)
        self.same = np.equal(
            rows[:, None, :CONTEXT], rows[:, CONTEXT + 1 - SCORED :, None], out=room("same", n, SCORED, CONTEXT, kind=bool)
        )
        copies = np.multiply(self.weights, self.same, out=room("copies", n, SCORED, CONTEXT))
        self.copied = copies @ np.ones(CONTEXT, np.float32) * self.share
        self.drawn = of_class * biases.within(before, self.target)
        self.chance = (1 - self.gate) * self.drawn + self.gate * self.copied + np.float32(1e-30)


def log_probs(params, biases: Biases, rows: np.ndarray, batch: int = 64) -> np.ndarray:
    """Natural log probability of each target, [row, SCORED]."""
    out, room = np.empty((len(rows), SCORED), np.float32), Room()
    for at in range(0, len(rows), batch):
        np.log(Pass(params, biases, rows[at : at + batch], room).chance, out=out[at : at + batch])
    return out


class Trainer:
    """Adagrad on batches of windows."""

    def __init__(self, params: dict[str, np.ndarray], biases: Biases, rate: float = 0.2):
        self.biases = biases
        self.params = {name: value.copy() for name, value in params.items()}
        self.squares = {name: np.full(value.shape, 1e-4, np.float32) for name, value in params.items()}
        self.rate = np.float32(rate)
        self.room = Room()

    def batch(self, rows: np.ndarray) -> float:
        """One step over rows of windows; returns the mean loss. Padding after the end of a text is no target."""
        p, room, size = self.params, self.room, len(rows)
        f = Pass(p, self.biases, rows, room)
        real = (f.target != START).astype(np.float32)
        n = np.float32(max(1.0, real.sum()))
        each = -real / (n * f.chance)
        gate = each * (f.copied - f.drawn) * f.gate * (1 - f.gate)
        pull = (each * (1 - f.gate) * f.drawn).reshape(-1)

        def times(name: str, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            return np.matmul(left, right, out=room(name, *left.shape[:-1], right.shape[-1]))

        logits = np.multiply(f.classes, (-pull / f.sums)[:, None], out=room("to_logits", *f.classes.shape))
        logits.reshape(-1)[f.at] += pull
        hidden = f.hidden.reshape(-1, DIM)
        back = times("back", logits, p["to_class"].T).reshape(f.hidden.shape)
        part = room("part", *back.shape)
        back += np.multiply(gate[:, :, None], p["to_gate"], out=part)
        np.multiply(f.hidden, f.hidden, out=part)
        back *= np.subtract(1, part, out=part)
        to_weights, copies = times("to_weights", back, f.v.transpose(0, 2, 1)), room("copies", *f.weights.shape)
        to_weights += np.multiply((each * f.gate)[:, :, None], f.same, out=copies)
        weights = f.weights
        weights *= f.share[:, :, None]
        to_weights *= weights
        to_weights -= np.multiply(weights, (to_weights @ np.ones(CONTEXT, np.float32))[:, :, None], out=copies)
        scale = np.float32(DIM**-0.5)
        q = times("to_q", to_weights, f.k).reshape(-1, DIM)
        k = times("to_k", to_weights.transpose(0, 2, 1), f.q).reshape(-1, DIM)
        v = times("to_v", weights.transpose(0, 2, 1), back).reshape(-1, DIM)
        back = back.reshape(-1, DIM)
        x = times("to_x", k, p["key"].T).reshape(size, CONTEXT, DIM)
        x += times("moved", v, p["value"].T).reshape(x.shape)
        x[:, :-1] += times("moved", k, p["key_before"].T).reshape(x.shape)[:, 1:]
        own = times("to_last", q, p["query"].T * scale)
        own += times("own", back, p["own"].T)
        x[:, CONTEXT - SCORED :] += own.reshape(size, SCORED, DIM)
        before, moved = room("before", size, CONTEXT - 1, DIM), room("after", size, CONTEXT - 1, DIM)
        before[:], moved[:] = f.x[:, :-1], k.reshape(size, CONTEXT, DIM)[:, 1:]
        flat = f.last.reshape(-1, DIM).T
        # Only the embeddings of tokens that occur change.
        occurs = np.zeros(TOKENS, bool)
        occurs[f.inputs] = True
        found = np.flatnonzero(occurs)
        number = np.empty(TOKENS, np.intp)
        number[found] = np.arange(len(found))
        place = np.add(number[f.inputs][:, :, None] * DIM, np.arange(DIM), out=room("place", size, CONTEXT, DIM, kind=np.intp))
        gradients = {
            "embedding": np.bincount(place.reshape(-1), x.reshape(-1), len(found) * DIM).reshape(-1, DIM),
            "query": flat @ q * scale,
            "key": f.x.reshape(-1, DIM).T @ k,
            "key_before": before.reshape(-1, DIM).T @ moved.reshape(-1, DIM),
            "value": f.x.reshape(-1, DIM).T @ v,
            "own": flat @ back,
            "distance": np.bincount(_BACK[_SEEN], to_weights.sum(axis=0)[_SEEN], CONTEXT),
            "to_class": hidden.T @ logits,
            "to_gate": hidden.T @ gate.reshape(-1),
            "gate": gate.sum(keepdims=True).reshape(1),
        }
        for name, gradient in gradients.items():
            gradient = gradient.astype(np.float32, copy=False)
            own = found if name == "embedding" else slice(None)
            squares = self.squares[name][own] + gradient * gradient
            self.squares[name][own] = squares
            gradient = gradient * self.rate
            gradient /= np.sqrt(squares)
            p[name][own] -= gradient
        return float(-(np.log(f.chance) * real).sum() / n)
