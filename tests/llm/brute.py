"""Plain versions of the operators, one row at a time."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def residue(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def raw(text):
    return (text or "").encode()


def simhash(text):
    words = raw(text).translate(LOWER).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(shingles))


def groups(prints, distance=4):
    """Fingerprint -> smallest fingerprint of its component, by comparing all pairs."""
    names = sorted(set(prints))
    parent = {x: x for x in names}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array(names, np.uint64)
    for i, x in enumerate(names):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ np.uint64(x)) <= distance):
            a, b = sorted((root(x), root(names[i + 1 + j])))
            parent[b] = a
    return {x: root(x) for x in names}


def components(docs):
    """Rows (id, fingerprint, smallest id) of (id, text) rows."""
    prints = [simhash(t) for _, t in docs]
    root = groups(prints)
    least = {}
    for (i, _), p in zip(docs, prints, strict=True):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return [(i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(docs, prints, strict=True)]


def kept_words(docs, width=20):
    """Rows (id, words, removed, sha256) of (id, text) rows in order."""
    seen, out = set(), []
    for i, text in docs:
        words = raw(text).split()
        gone = [False] * len(words)
        for at in range(len(words) - width + 1):
            window = b" ".join(words[at : at + width])
            if window in seen:
                gone[at : at + width] = [True] * width
            seen.add(window)
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out.append((i, len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def contamination(docs, items, width=13):
    windows = {}
    for item, text in items:
        words = ALNUM.findall(raw(text).translate(LOWER))
        for at in range(max(len(words) - width + 1, 1) if words else 0):
            windows.setdefault(tuple(words[at : at + width]), set()).update([] if item is None else [str(item)])
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        words, hit, found = ALNUM.findall(raw(text).translate(LOWER)), set(), set()
        for n in lengths:
            for at in range(len(words) - n + 1):
                if tuple(words[at : at + n]) in windows:
                    hit.update(range(at, at + n))
                    found |= windows[tuple(words[at : at + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def unigrams(docs):
    """Rows (id, tokens, known, training tokens, base score)."""
    counts = Counter()
    for i, text in docs:
        if i is None or residue(i, 10):
            counts.update([*raw(text).translate(LOWER).split(), "END"])
    total = sum(counts.values())
    scale = math.log10(total + 0.1 * (len(counts) + 1))
    out = []
    for i, text in docs:
        words = [*raw(text).translate(LOWER).split(), "END"]
        out.append((i, len(words), sum(w in counts for w in words), total, sum(math.log10(counts[w] + 0.1) - scale for w in words)))
    return out


class ContextTree:
    """Context-tree weighting as in the book: recursive, over dictionaries."""

    def __init__(self, texts, depth):
        self.depth, self.counts = depth, {}
        for text in texts:
            line = bytes(depth) + raw(text).translate(LOWER) + b"\xff"
            for at in range(depth, len(line)):
                for d in range(depth + 1):
                    context = line[at - d : at][::-1]
                    for bit in range(8):
                        node = (context, bit, line[at] >> (8 - bit))
                        self.counts.setdefault(node, [0, 0])[line[at] >> (7 - bit) & 1] += 1
        self.children = {}
        for context, bit, lead in self.counts:
            if context:
                self.children.setdefault((context[:-1], bit, lead), []).append((context, bit, lead))
        self.weights = {}

    def estimate(self, node):
        a, b = self.counts[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, node):
        if node not in self.weights:
            own = self.estimate(node)
            if len(node[0]) < self.depth:
                below = sum(self.weighted(c) for c in self.children[node])
                own = float(np.logaddexp(own, below)) - math.log(2)
            self.weights[node] = own
        return self.weights[node]

    def score(self, text):
        line, total = bytes(self.depth) + raw(text).translate(LOWER) + b"\xff", 0.0
        for at in range(self.depth, len(line)):
            for bit in range(8):
                one, chance = line[at] >> (7 - bit) & 1, None
                for d in range(self.depth, -1, -1):
                    node = (line[at - d : at][::-1], bit, line[at] >> (8 - bit))
                    if node not in self.counts:
                        continue
                    counts = self.counts[node]
                    here = (counts[one] + 0.5) / (sum(counts) + 1)
                    if chance is None:
                        chance = here
                    else:
                        stop = math.exp(self.estimate(node) - math.log(2) - self.weighted(node))
                        chance = stop * here + (1 - stop) * chance
                total += math.log10(0.5 if chance is None else chance)
        return total


def subsequence(a, b):
    """Length of a longest common subsequence."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def shingle_set(text, width=3):
    words = raw(text).translate(LOWER).split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1)))


def set_components(docs, percent=85):
    """Rows (id, set size, smallest id) of (id, text) rows, by comparing all pairs of distinct sets."""
    sets = [shingle_set(t) for _, t in docs]
    distinct = sorted({s for s in sets if s}, key=lambda s: (len(s), sorted(s)))
    parent = {s: s for s in distinct}

    def root(x):
        while parent[x] is not x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if 100 * len(a) < percent * len(b):
                break
            shared = len(a & b)
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                parent[root(b)] = root(a)
    least = {}
    for (i, _), s in zip(docs, sets, strict=True):
        if s and i is not None:
            least[root(s)] = min(i, least.get(root(s), i))
    return [(i, len(s), least.get(root(s)) if s else i) for (i, _), s in zip(docs, sets, strict=True)]


def clusters(rows, k=40, rounds=5, scale=256):
    """Rows (id, cluster, distance, cluster inertia, inertia, centroid digest) of (id, vector) rows, in Python integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [x for _, x in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, x in kept:
            members.setdefault(nearest(x)[1], []).append(x)
        for j, xs in members.items():
            centroids[j] = [sum(column) // len(xs) for column in zip(*xs, strict=True)]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    per = Counter()
    for _, j, d in found:
        per[j] += d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, j, d, per[j], sum(per.values()), digests[j]) for i, j, d in found]


def bundle(text):
    """Sum of the bound trigram vectors of a text, letter by letter."""
    from vinework.llm import langid

    line = [0, *(ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in "".join(c if c.isalpha() else " " for c in text or "")), 0]
    line = [0 if c == 32 else c for c in line]
    total = np.zeros(langid.DIMENSIONS)
    for grams, n in Counter((a, b, c) for a, b, c in zip(line, line[1:], line[2:], strict=False) if b).items():
        vectors = [np.roll(langid._vector(x), k).astype(float) for x, k in zip(grams, (2, 1, 0), strict=True)]
        total += n * (vectors[0] * vectors[1] * vectors[2])
    return total


def licence_score(unit, templates, lines):
    """Largest TF-IDF cosine of a unit with a template and its licence; ``lines`` are all lines of the corpus as sets of words."""
    idf = lambda w: math.log((len(lines) + 2) / (sum(w in line for line in lines) + 1))
    known = {w for _, t in templates for w in ALNUM.findall(raw(t).translate(LOWER))}
    weigh = lambda words: {w: n * (idf(w) if w in known else math.log(len(lines) + 2)) for w, n in Counter(words).items()}
    own = weigh(ALNUM.findall(unit.translate(LOWER)))
    norm = math.sqrt(sum(x * x for x in own.values()))
    best = (0.0, "")
    for name, text in templates:
        other = weigh(ALNUM.findall(raw(text).translate(LOWER)))
        product = sum(x * other.get(w, 0) for w, x in own.items())
        cosine = product / (norm * math.sqrt(sum(x * x for x in other.values()))) if norm else 0.0
        best = min(best, (-cosine, name))
    return -best[0], best[1]


def inherited(licensed, directory):
    """Nearest directory with a licence, itself or above."""
    parts = directory.split("/")
    for n in range(len(parts), -1, -1):
        if "/".join(parts[:n]) in licensed:
            return "/".join(parts[:n])
    return None


def lexicon(rows, phrases=()):
    """Entries and weights by the rules of the operator, from (text, label) rows."""
    from vinework.llm import toxicity as op

    counts, label_rows = {}, Counter(label for _, label in rows)
    for text, label in rows:
        words = set(op.fold(text).split())
        features = {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in range(op.SHORTEST, op.LONGEST + 1) if len(w) >= n}
        for f in features:
            counts.setdefault(f, [0, 0])[label] += 1
    weight = lambda a, b: math.log((a + 0.5) / (label_rows[1] + 1)) - math.log((b + 0.5) / (label_rows[0] + 1))
    chosen, taken = {}, {}
    for entry in sorted(counts, key=lambda e: (-len(e.strip()), not e.endswith(" "), e)):
        clean, toxic = counts[entry]
        if toxic < op.LEAST_ROWS or weight(toxic, clean) < op.LEAST_WEIGHT:
            continue
        gone = taken.get(entry, (0, 0))
        a, b = toxic - gone[0], clean - gone[1]
        if a < op.LEAST_ROWS or weight(max(a, 0), max(b, 0)) < op.LEAST_WEIGHT:
            continue
        chosen[entry] = weight(max(a, 0), max(b, 0))
        word = entry.strip()
        for n in range(op.SHORTEST, min(len(word), op.LONGEST) + 1):
            if f" {word[:n]}" != entry:
                old = taken.get(f" {word[:n]}", (0, 0))
                taken[f" {word[:n]}"] = (old[0] + a, old[1] + b)
    found = {}
    for text, label in rows:
        words = op.fold(text).split()
        begins = {w for w in words if any(f" {w[:n]}" in chosen for n in range(1, len(w) + 1))}
        hits = begins | {w for w in words if f" {w} " in chosen}
        for p in {f" {w} " for w in begins} | {f" {a} {b} " for a, b in zip(words, words[1:], strict=False) if {a, b} & hits}:
            found.setdefault(p, [0, 0])[label] += 1
    for p, (clean, toxic) in found.items():
        if clean >= op.LEAST_CLEAN and toxic / label_rows[1] <= clean / label_rows[0]:
            chosen[p] = 0.0
    return chosen | {op.fold(p): 0.0 for p in phrases}


def matched_weight(entries, folded):
    """Sum over words of the longest entry that begins there, outside of what an earlier one covers."""
    total, free = 0.0, 0
    for at in range(len(folded)):
        here = [e for e in entries if folded.startswith(e, at)]
        if here and at >= free:
            longest = max(here, key=len)
            total += entries[longest]
            free = at + len(longest) - 1
    return total


def differenced(pages):
    """Kept blocks of (host, path, blocks) pages in order: those not in the longest common subsequence with the nearer neighbour."""
    from vinework.llm import pages as op

    order = sorted(range(len(pages)), key=lambda i: pages[i][:2])
    out = [None] * len(pages)
    for at, i in enumerate(order):
        near = [order[j] for j in (at - 1, at + 1) if 0 <= j < len(order) and pages[order[j]][0] == pages[i][0]]
        if not near:
            out[i] = pages[i][2]
            continue
        other = max(near, key=lambda j: op._common_path(pages[j][1], pages[i][1]))
        a, b = pages[i][2], pages[other][2]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for x in range(len(a)):
            for y in range(len(b)):
                table[x + 1][y + 1] = table[x][y] + 1 if a[x] == b[y] else max(table[x][y + 1], table[x + 1][y])
        x, y, shared = len(a), len(b), set()
        while x and y:
            if a[x - 1] == b[y - 1]:
                shared.add(x - 1)
                x, y = x - 1, y - 1
            elif table[x - 1][y] >= table[x][y - 1]:
                x -= 1
            else:
                y -= 1
        out[i] = [t for k, t in enumerate(a) if k not in shared]
    return out
