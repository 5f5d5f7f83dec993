"""Secrets in texts: three fixed patterns, and a character convolutional network for the rest."""

import copy
import hashlib
import itertools
import re
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from commwatch.llm.arrow_text import chunks, flat, mix, runs
from commwatch.llm.storage import map_arrow, stored

# The base patterns. On bytes, case folding is that of ASCII.
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE,
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "model")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

LEAST_CANDIDATE = 16
# Candidates of a known kind that is no secret: words, short numbers and dates between marks
PLAIN = re.compile(rb"[+/_.=-]*(?:(?:[A-Z]?[a-z]{1,15}|[A-Z]{1,15}|[0-9]{1,8})(?:[+/_.=-]+|$))+")
BEFORE, INSIDE, AFTER = 24, 48, 16
WINDOW = BEFORE + INSIDE + AFTER
STRIDE = INSIDE // 2  # between the windows of a longer run
BLOCK = 4096  # windows judged at once
TRAIN_BLOCK = 4096  # windows that one chain of steps learns from, between two averages
FILE_BLOCKS = 16  # blocks of a file, where there are many
LEAST_EACH = 256  # windows of each label in a block; a rarer label is dealt to several
ROUNDS, STEPS = 8, 50  # averages, and the least steps before each; at least one pass over a block
CELL = 64  # calibration cells in a unit of logits
MOST_LOGIT = 64
LEAST_RECALL = 0.98
EMBED, FILTERS, SPAN = 8, 24, 5


def _byte_classes():
    """Input symbol of each byte: printable ASCII one by one, line ends, other control, the rest."""
    symbol = np.full(256, 1)
    symbol[32:127] = np.arange(4, 99)
    symbol[[10, 13]] = 2
    symbol[128:] = 3
    return symbol


SYMBOLS = 99  # with 0 for places beyond the text
_SYMBOL = _byte_classes()


def _member(marks):
    table = np.zeros(256, bool)
    table[list(marks)] = True
    return table


_ALPHABET = bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123))
_HEX = _member(b"0123456789abcdef")
_DIGIT = _member(b"0123456789")
_LETTER = _member(_ALPHABET[10:])
_SIGN = _member(_ALPHABET)
_TOKEN = _member(_ALPHABET + b"+/_.=-")


class Scanned:
    """Base spans and candidates of a chunk of texts, as bytes of the chunk."""

    def __init__(self, column):
        self.data, self.at = flat(column)
        letters = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=letters[1:])
        self.points = letters
        self.values = [[] for _ in range(len(column))]  # what the keyword's assignments assign
        self.spans = [self._patterns(k) for k in range(len(column))]
        first, last = self._long_runs(_HEX, LEAST["hex"])
        for k, a, b in self._of_text(first, last):
            self.spans[k].append(("hex", a, b))
        first, last = self._long_runs(_TOKEN, LEAST_CANDIDATE)
        self.candidates = [[] for _ in self.spans]
        for k, a, b in self._of_text(first, last):
            self.candidates[k].append((a, b))

    def _long_runs(self, member, least):
        first, last = runs(member[self.data], self.at)
        long = last - first >= least
        return first[long], last[long]

    def _of_text(self, first, last):
        return zip((np.searchsorted(self.at, first, "right") - 1).tolist(), first.tolist(), last.tolist())

    def _patterns(self, k):
        begin = int(self.at[k])
        text = self.data[begin : self.at[k + 1]].tobytes()
        found = []
        low = text.lower()
        if any(w in low for w in KEYWORDS):
            long = [m for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
            found += [("assign", begin + m.start(), begin + m.end()) for m in long]
            self.values[k] = [(begin + m.start(2), begin + m.end(2)) for m in long]
        if b"AKIA" in text:
            found += [
                ("access", begin + m.start(), begin + m.end())
                for m in ACCESS.finditer(text)
                if m.end() - m.start() >= LEAST["access"]
            ]
        return found

    def free(self, k):
        """Candidates of a text, or the parts of them that base spans leave, marks alone excepted."""
        spans = sorted({(a, b) for _, a, b in self.spans[k]})
        left, i = [], 0
        for first, last in self.candidates[k]:
            while i < len(spans) and spans[i][1] <= first:
                i += 1
            at = first
            for j in range(i, len(spans)):
                a, b = spans[j]
                if a >= last:
                    break
                left.append((at, min(a, last)))
                at = max(at, b)
            left.append((at, last))
        return [(a, b) for a, b in left if a < b and _SIGN[self.data[a:b]].any()]

    def windows(self, k, places):
        """Input symbols of a text's spans and their surroundings, and what lies inside."""
        begin, end = int(self.at[k]), int(self.at[k + 1])
        rows = np.zeros((len(places), WINDOW), np.int64)
        inside = np.zeros((len(places), WINDOW), np.float32)
        for row, mark, (a, b) in zip(rows, inside, places):
            low, high = max(begin, a - BEFORE), min(end, a + INSIDE + AFTER, b + AFTER)
            row[low - a + BEFORE : high - a + BEFORE] = _SYMBOL[self.data[low:high]]
            mark[BEFORE : BEFORE + min(b - a, INSIDE)] = 1
        return rows, inside

    def named(self, k, spans):
        """Spans as ``kind:start:end`` in code points of the text, by start, then by kind."""
        zero = self.points[self.at[k]]
        order = sorted((a, KINDS.index(kind), b) for kind, a, b in spans)
        return [
            (KINDS[kind], int(self.points[a] - zero), int(self.points[b] - zero))
            for a, kind, b in order
        ]


def pieces(a, b):
    """Overlapping places of at most ``INSIDE`` bytes that make up a span."""
    last = max(a, b - INSIDE)
    return [(at, min(b, at + INSIDE)) for at in (*range(a, last, STRIDE), last)]


class Network:
    """Embedding, one convolution, the maximum over all places, one logistic unit; in numpy."""

    def __init__(self, seed=0):
        draw = np.random.default_rng(seed)
        self.w = {
            "embed": draw.normal(0, 0.3, (SYMBOLS, EMBED)),
            "filter": draw.normal(0, 0.3, ((EMBED + 1) * SPAN, FILTERS)),
            "shift": np.zeros(FILTERS),
            "out": draw.normal(0, 0.3, FILTERS),
            "bias": np.zeros(1),
        }
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        # of Adam: the moments of the gradient and the steps so far
        self.first = {k: np.zeros_like(v) for k, v in self.w.items()}
        self.second = {k: np.zeros_like(v) for k, v in self.w.items()}
        self.count = 0
        self.scale, self.offset, self.threshold = 1.0, 0.0, 0.5

    def _forward(self, rows, inside):
        x = np.concatenate([self.w["embed"][rows], inside[..., None]], 2)
        seen = np.lib.stride_tricks.sliding_window_view(x, SPAN, axis=1).transpose(0, 1, 3, 2)
        seen = seen.reshape(*seen.shape[:2], -1)
        z = seen @ self.w["filter"] + self.w["shift"]
        best = z.argmax(1)
        top = np.maximum(np.take_along_axis(z, best[:, None], 1)[:, 0], 0)
        return seen, best, top, top @ self.w["out"] + self.w["bias"][0]

    def logits(self, rows, inside):
        parts = [
            self._forward(rows[i : i + 512], inside[i : i + 512])[3] for i in range(0, len(rows), 512)
        ]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def chance(self, logits):
        return 1 / (1 + np.exp(-(self.scale * logits + self.offset)))

    def probability(self, rows, inside):
        return self.chance(self.logits(rows, inside))

    def _gradient(self, rows, inside, labels):
        seen, best, top, logit = self._forward(rows, inside)
        error = (1 / (1 + np.exp(-logit)) - labels) / len(labels)
        back = error[:, None] * self.w["out"] * (top > 0)
        chosen = np.take_along_axis(seen, best[..., None], 1)  # (row, filter, input)
        step = {
            "out": top.T @ error,
            "bias": np.array([error.sum()]),
            "shift": back.sum(0),
            "filter": np.einsum("nf,nfi->if", back, chosen),
        }
        inputs = (back[..., None] * self.w["filter"].T).reshape(*back.shape, SPAN, EMBED + 1)
        places = best[..., None] + np.arange(SPAN)
        symbols = np.take_along_axis(rows[:, None, :], places, 2)
        symbols, inputs = symbols.reshape(-1), inputs.reshape(-1, EMBED + 1)
        embed = [np.bincount(symbols, inputs[:, i], SYMBOLS) for i in range(EMBED)]
        return step | {"embed": np.stack(embed, 1).astype(self.w["embed"].dtype)}

    def learned(self):
        """Weights and moments as one row of numbers, which can be averaged."""
        return np.concatenate([v.ravel() for part in (self.w, self.first, self.second) for v in part.values()])

    def take(self, numbers, count):
        """Go on from weights and moments as ``learned`` gives them, after ``count`` steps."""
        at = 0
        for part in (self.w, self.first, self.second):
            for k, v in part.items():
                part[k] = numbers[at : at + v.size].reshape(v.shape).astype(np.float32)
                at += v.size
        self.count = count
        return self

    def fit(self, rows, inside, labels, steps=400, batch=128, rate=0.01, seed=1):
        """Adam on the cross entropy, from where it stands: whole passes of ``steps`` steps or more.

        Most rows lose their surroundings or get those of others, as a keyword near by is what other
        kinds of secrets lack. Some findings get random letters and digits
        in place of their own, as a secret is known by its disorder and not by its alphabet.
        """
        plain = np.isin(np.arange(SYMBOLS), _SYMBOL[list(_ALPHABET)])
        draw = np.random.default_rng(seed)
        first, second = self.first, self.second
        # the rarer label as often as the other
        each = [np.flatnonzero(labels == label) for label in (0, 1)]
        most = max(map(len, each))
        every = np.concatenate([np.resize(at, most) for at in each if len(at)])
        for _ in range(-(-steps * batch // len(every))):
            for part in np.array_split(draw.permutation(every), max(1, len(every) // batch)):
                self.count += 1
                around = inside[part] == 0
                blank = (draw.random(len(part)) < 0.5)[:, None] & around
                lent = (draw.random(len(part)) < 0.5)[:, None] & around
                shown = np.where(lent, rows[draw.permutation(part)], rows[part])
                shown = np.where(blank, 0, shown)
                drawn = (draw.random(len(part)) < 0.3)[:, None] & (labels[part] == 1)[:, None]
                drawn = drawn & (inside[part] == 1) & plain[shown]
                other = _SYMBOL[draw.choice(list(_ALPHABET), shown.shape)]
                grad = self._gradient(np.where(drawn, other, shown), inside[part], labels[part])
                for k, g in grad.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    a, b = first[k] / (1 - 0.9**self.count), second[k] / (1 - 0.999**self.count)
                    self.w[k] -= (rate * a / (np.sqrt(b) + 1e-8)).astype(np.float32)
        return self

    def calibrate(self, rows, inside, labels):
        """Platt's scale on rows apart, then a threshold with at least the wanted recall there.

        Of these the one with the best F1 is taken, the lowest of equal ones. One below one half is
        tried too, as recall comes first.
        """
        x = self.logits(rows, inside)
        return self.calibrate_counts(x, x, labels, np.ones(len(x)))

    def calibrate_counts(self, x, low, labels, n):
        """As ``calibrate``, from cells of ``n`` rows with logits of about ``x``, the lowest ``low``."""
        y = labels
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            w, r = n * (p * (1 - p) + 1e-6), n * (p - y)
            ga, gb = (r * x).sum() + 1e-2 * (a - 1), r.sum() + 1e-2 * b
            haa, hab, hbb = (w * x * x).sum() + 1e-2, (w * x).sum(), w.sum() + 1e-2
            det = haa * hbb - hab * hab
            a, b = a - (hbb * ga - hab * gb) / det, b - (haa * gb - hab * ga) / det
        self.scale, self.offset = float(a), float(b)
        chance = self.chance(low)
        least = chance[y == 1].min(initial=1.0)  # always meets the recall
        true, best = n[y == 1].sum(), -1.0
        for threshold in np.unique(np.append(chance[chance >= min(least, 0.5)], 0.5)):
            over = chance >= threshold
            hits, told = n[over & (y == 1)].sum(), n[over].sum()
            f1 = 2 * hits / max(1, told + true)
            if f1 > best and hits >= LEAST_RECALL * true:
                best, self.threshold = f1, float(threshold)
        return self


def _made(words, draw):
    """A path, host name, compound, version or date of ordinary words: no secret."""
    words = [w if (draw >> (7 + i)) % 4 else w.capitalize() for i, w in enumerate(words)]
    mark = (b"-", b"_", b"/", b".", b"", b"=", b"+", b"/")[draw % 8]
    number = b"%d" % (draw % 10 ** (1 + draw // 8 % 8))
    year, month, day = b"%04d" % (1970 + draw % 80), b"%02d" % (1 + draw % 12), b"%02d" % (1 + draw % 28)
    date = (b"-", b"/", b".", b"")[draw // 16 % 4].join((year, month, day))
    kind = draw // 64 % 5
    if kind == 0:
        return mark.join([*words, number])
    if kind == 1:
        return b"www." + b".".join(words) + b".com/" + number + b".html"
    if kind == 2:
        return date + (b"T%02d" % (draw % 24) if draw % 3 else b"/") + mark.join(words)
    return (mark.join(words) + (mark or b"-") + date) if kind == 3 else mark.join(words)


def _made_window(scan, k, words, draw):
    """The window of a made candidate in place of a text's words."""
    begin, end = int(scan.at[k]), int(scan.at[k + 1])
    made = _made([scan.data[a:b].tobytes() for a, b in words], draw)
    a, b = pieces(0, len(made))[draw // 512 % len(pieces(0, len(made)))]
    before = scan.data[max(begin, words[0][0] - BEFORE) : words[0][0]].tobytes()
    before = (before + made[:a])[-BEFORE:]
    after = (made[b:] + scan.data[words[-1][1] : min(end, words[-1][1] + AFTER)].tobytes())[:AFTER]
    row, inside = np.zeros((1, WINDOW), np.int64), np.zeros((1, WINDOW), np.float32)
    shown = np.frombuffer(before + made[a:b] + after, np.uint8)
    row[0, BEFORE - len(before) : BEFORE - len(before) + len(shown)] = _SYMBOL[shown]
    inside[0, BEFORE : BEFORE + b - a] = 1
    return row, inside


def _label(batches):
    """Training rows: base findings, and of each text what is known to be none.

    Candidates without a base finding have no label, as they may be secrets of other kinds. None are
    words, digits, candidates that are ``PLAIN``, and paths, names and dates made of words.
    """
    for batch in batches:
        for chunk in chunks(batch):
            scan = Scanned(chunk.column("text"))
            wide, deep, labels = [], [], []
            word_first, word_last = scan._long_runs(_TOKEN, 6)
            owner = np.searchsorted(scan.at, word_first, "right") - 1
            pick, ordinary = {}, [[] for _ in scan.spans]
            for k, a, b in zip(owner.tolist(), word_first.tolist(), word_last.tolist()):
                if b - a < LEAST_CANDIDATE:
                    pick[k] = (a, b)  # one ordinary word of each text
            letters = scan._long_runs(_LETTER, 3)
            for k, a, b in scan._of_text(*letters):
                if b - a < LEAST_CANDIDATE:
                    ordinary[k].append((a, b))
            for k, spans in enumerate(scan.spans):
                digits_only = {
                    (a, b) for kind, a, b in spans if kind == "hex" and _DIGIT[scan.data[a:b]].all()
                }
                # values without their keyword, which other kinds of secrets lack
                true = [(a, b) for kind, a, b in spans if kind != "assign" and (a, b) not in digits_only]
                apart = {*true, *digits_only}
                true += [v for v in scan.values[k] if v not in apart]
                plain = [c for c in scan.free(k) if PLAIN.fullmatch(scan.data[c[0] : c[1]].tobytes())]
                plain = {p for c in plain for p in (pieces(*c)[0], pieces(*c)[-1])}
                false = [*digits_only, *plain, *([pick[k]] if k in pick else [])]
                parts = [scan.windows(k, true + false)]
                if ordinary[k]:
                    draw = zlib.crc32(scan.data[scan.at[k] : scan.at[k + 1]])
                    at = draw % len(ordinary[k])
                    parts.append(_made_window(scan, k, ordinary[k][at : at + 2 + draw // 8 % 7], draw))
                for rows, inside in parts:
                    wide.append(rows)
                    deep.append(inside)
                labels += [1] * len(true) + [0] * (len(false) + len(parts) - 1)
            rows = np.concatenate(wide).astype(np.uint8)
            inside = np.concatenate(deep).astype(np.uint8)
            both = np.concatenate([rows, inside], 1)
            keys = mix((both.astype(np.uint64) * mix(np.arange(2 * WINDOW, dtype=np.uint64))).sum(1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(labels, np.int32)),
                    pa.array(keys.view(np.int64)),
                    pa.array([r.tobytes() for r in both], pa.binary()),
                ],
                ["label", "draw", "window"],
            )


def _opened(windows):
    """Input symbols of stored windows, and what lies inside."""
    both = np.frombuffer(b"".join(windows.to_pylist()), np.uint8).reshape(-1, 2 * WINDOW)
    return both[:, :WINDOW].astype(np.int64), both[:, WINDOW:].astype(np.float32)


def _learn(batches, network, turn):
    """What the network becomes by each block's windows alone, a row per number."""
    for batch in batches:
        for k, block in enumerate(batch.column("block").to_pylist()):
            rows = batch.column("rows")[k].values
            labels = rows.field("label").to_numpy(zero_copy_only=False).astype(np.float32)
            own = copy.deepcopy(network)
            own.fit(*_opened(rows.field("window")), labels, steps=STEPS, seed=[turn, block])
            numbers = own.learned().astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(numbers), dtype=np.int32)),
                    pa.array(numbers),
                    pa.array(np.full(len(numbers), own.count - network.count)),
                ],
                ["place", "number", "steps"],
            )


def _cells(batches, network):
    """Logits of windows with their surroundings and without, and their cells."""
    for batch in batches:
        window, inside = _opened(batch.column("window"))
        for shown in (window, np.where(inside > 0, window, 0)):
            x = network.logits(shown, inside).astype(np.float64)
            cell = np.floor(CELL * np.clip(x, -MOST_LOGIT, MOST_LOGIT)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(cell), pa.array(x)], ["label", "cell", "x"]
            )


def _fitted(windows, count):
    """A network fitted to all ``windows``, of which there are ``count`` by label.

    The windows are dealt by their hashes into blocks of about ``TRAIN_BLOCK``, as many as the table
    needs. In each round every block goes on from the same network with Adam's steps over all its
    windows, and the mean of what they become is the next network (local steps with averaging).
    A rare label is dealt to several blocks, as each needs both.
    """
    blocks = -(-sum(count.values()) // TRAIN_BLOCK)
    copies = F.lit(1)
    for label, n in count.items():
        several = min(blocks, max(1, -(-LEAST_EACH * blocks // n)))
        copies = F.when(F.col("label") == label, F.lit(several)).otherwise(copies)
    turn = F.explode(F.sequence(F.lit(0), copies - 1)).alias("turn")
    place = F.pmod(F.shiftright("draw", 2) + F.col("turn"), F.lit(blocks)).cast("int")
    dealt = windows.select("label", "draw", "window", turn).withColumn("block", place)
    # a file has few blocks: they are small for what they cost
    files = min(blocks, max(windows.sparkSession.sparkContext.defaultParallelism, blocks // FILE_BLOCKS))
    rows = F.sort_array(F.collect_list(F.struct("label", "draw", "window")))
    grouped = dealt.repartitionByRange(files, "block").groupBy("block").agg(rows.alias("rows"))
    dealt = stored(grouped, "blocks")
    network = Network()
    for turn in range(ROUNDS):
        run = partial(_learn, network=network, turn=turn)
        learned = map_arrow(dealt, run, "place int, number double, steps long")
        # decimals add up to the same in any order
        mean = F.sum(F.col("number").cast("decimal(38,18)")).cast("double") / F.count("*")
        means = learned.groupBy("place").agg(mean.alias("mean"), F.max("steps").alias("steps")).collect()
        numbers = np.array([r["mean"] for r in sorted(means, key=lambda r: r.place)])
        network.take(numbers, network.count + means[0].steps)
    return network


def train(df):
    """A network fitted to the base findings of ``df`` against its words and other known kinds.

    All different windows of the table take part: by their hashes, three quarters are fitted and
    the rest calibrate, unless one of these parts would lack a label: then its windows do both.
    Calibration counts all its windows in cells of a narrow span of logits. None where a label is
    missing. The driver gets the network's numbers and the cells' counts only.
    """
    schema = "label int, draw long, window binary"
    found = map_arrow(df.select("text"), _label, schema)
    # equal windows have equal hashes, so copies of a text count once
    once = found.groupBy("label", "draw").agg(F.first("window").alias("window"))
    windows = stored(once.withColumn("apart", F.pmod("draw", F.lit(4)) == 3), "windows")
    count = {(r.label, r.apart): r["count"] for r in windows.groupBy("label", "apart").count().collect()}
    if len({label for label, _ in count}) < 2:
        return None
    both = [label for label in (0, 1) if not (count.get((label, True)) and count.get((label, False)))]
    fits = ~F.col("apart") | F.col("label").isin(both)
    of = {label: sum(n for (x, apart), n in count.items() if x == label and (label in both or not apart)) for label in (0, 1)}
    network = _fitted(windows.where(fits), of)
    calibrating = windows.where(F.col("apart") | F.col("label").isin(both)).select("label", "window")
    logits = map_arrow(calibrating, partial(_cells, network=network), "label int, cell int, x double")
    cells = logits.groupBy("label", "cell").agg(F.count("*").alias("n"), F.min("x").alias("low"))
    cells = sorted(cells.collect())
    label, cell, n, low = (np.array(c, np.float64) for c in zip(*cells))
    return network.calibrate_counts((cell + 0.5) / CELL, low, label, n)


def _chances(scan, network, every):
    """The highest probability over the pieces of each ``(text, span)``."""
    best = np.zeros(len(every))
    shown = ((n, k, p) for n, (k, c) in enumerate(every) for p in pieces(*c))
    while block := list(itertools.islice(shown, BLOCK)):
        parts = [scan.windows(k, [p]) for _, k, p in block]
        chance = network.probability(*(np.concatenate(x) for x in zip(*parts)))
        np.maximum.at(best, [n for n, _, _ in block], chance)
    return best.tolist()


def _scan(batches, network, redact):
    for batch in batches:
        for chunk in chunks(batch):
            scan = Scanned(chunk.column("text"))
            every = [(k, c) for k in range(chunk.num_rows) for c in scan.free(k)]
            added = [[] for _ in scan.spans]
            if network is not None:
                for (k, (a, b)), chance in zip(every, _chances(scan, network, every)):
                    if chance >= network.threshold:
                        added[k].append(("model", a, b))
            rows = []
            for k, base in enumerate(scan.spans):
                plain = ",".join(f"{n}:{a}:{b}" for n, a, b in scan.named(k, base))
                spans = scan.named(k, base + added[k])
                kinds = [n for n, _, _ in base]
                rows.append((
                    *(kinds.count(n) for n in KINDS[:3]),
                    hashlib.sha256(plain.encode()).hexdigest(),
                    ",".join(f"{n}:{a}:{b}" for n, a, b in spans),
                ))
            columns = list(zip(*rows))
            arrays = [pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(c) for c in columns[3:]]
            names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            if redact:
                texts = chunk.column("text").to_pylist()
                clean = [t if t is None else _redacted(t, r[4]) for t, r in zip(texts, rows)]
                arrays.append(pa.array(clean, pa.string()))
                names.append("clean_text")
            carried = [n for n in chunk.schema.names if n.startswith("c_")]
            yield pa.RecordBatch.from_arrays(
                [*(chunk.column(n) for n in carried), *arrays], [*carried, *names]
            )


def _redacted(text, spans):
    """The text with each span, or overlapping spans as one, replaced by its kind in brackets."""
    parts, at = [], 0
    for span in filter(None, spans.split(",")):
        kind, a, b = span.split(":")
        a, b = int(a), int(b)
        if a >= at:
            parts += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def scan_secrets(df, network, columns=("doc_id",), redact=False):
    """One row per document: counts of base findings, their hash and all spans.

    Spans read ``kind:start:end`` in code points, end exclusive, by start and then by kind. The
    network (None: base patterns alone) adds spans of kind ``model`` at candidates: runs of 16 or
    more characters of tokens, or the parts of them that base spans leave, by the most suspicious
    piece of each. Shorter runs are not judged. ``columns`` are carried along. ``redact`` adds ``clean_text``, in which each span is replaced by its kind.

    Null text counts as empty and stays null in ``clean_text``. Repeated rows are scanned one by
    one; an empty table gives no rows. One pass, no shuffle; the network is some kilobytes.
    """
    carried = df.select(*(F.col(c).alias(f"c_{c}") for c in columns), "text")
    types = [f"c_{c} {df.schema[c].dataType.simpleString()}" for c in columns]
    schema = ", ".join(
        [*types, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"]
        + ["clean_text string"] * redact
    )
    found = map_arrow(carried, partial(_scan, network=network, redact=redact), schema)
    return found.withColumnsRenamed({f"c_{c}": c for c in columns})


def secret_report(df):
    """The findings of every text, by a network trained on the table's own base findings."""
    return scan_secrets(df, train(df))
