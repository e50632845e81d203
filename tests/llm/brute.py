"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SOLID, PLAIN = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def solid(text):
    return SOLID.findall(text or "")


def plain(text):
    return PLAIN.findall((text or "").translate(LOWER))


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def windows(words, size):
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def covered(n, spans):
    gone = [False] * n
    for a, b in spans:
        gone[a:b] = [True] * (b - a)
    return gone


def byte_dedup(rows, length=200):
    """n_bytes, n_removed, n_spans and kept_sha256 of every (doc_id, text)."""
    data = [(text or "").encode() for _, text in rows]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(rows, data):
        gone = covered(len(b), [(i, i + length) for i in range(len(b) - length + 1) if seen[b[i : i + length]] > 1])
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((doc_id, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def word_dedup(rows, size=13):
    """doc_id, n_words, n_removed and kept text of every (doc_id, text)."""
    least = {}
    for doc_id, text in rows:
        if doc_id is not None:
            for w in windows(solid(text), size):
                least[w] = min(least.get(w, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        words = solid(text)
        hit = [(i, i + size) for i, w in enumerate(windows(words, size)) if doc_id is not None and least[w] < doc_id]
        gone = covered(len(words), hit)
        out.append((doc_id, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def shingle_set(text):
    words = solid((text or "").translate(LOWER))
    return set(windows(words, 5)) if len(words) >= 5 else {tuple(words)} if words else set()


def near_components(rows, similarity=85):
    """component of every doc_id that is not null, by links of so many per cent."""
    sets = [(doc_id, shingle_set(text)) for doc_id, text in rows if doc_id is not None]
    parent = {doc_id: doc_id for doc_id, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_shingle, common = defaultdict(list), Counter()
    for k, (_, s) in enumerate(sets):
        for x in s:
            by_shingle[x].append(k)
    for members in by_shingle.values():
        common.update((a, b) for i, a in enumerate(members) for b in members[i + 1 :])
    for (a, b), n in common.items():
        if 100 * n >= similarity * (len(sets[a][1]) + len(sets[b][1]) - n):
            x, y = root(sets[a][0]), root(sets[b][0])
            parent[max(x, y)] = min(x, y)
    return {doc_id: root(doc_id) for doc_id in parent}


def leaks(rows, items, size=10):
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every (doc_id, text)."""
    of_window = defaultdict(set)
    for item_id, text in items:
        words = plain(text)
        for w in windows(words, min(size, len(words))) if words else []:
            of_window[w].add(item_id)
    sizes = {len(w) for w in of_window}
    out = []
    for doc_id, text in rows:
        words, spans, found = plain(text), [], set()
        for k in sizes:
            for i, w in enumerate(windows(words, k)):
                if w in of_window:
                    spans.append((i, i + k))
                    found |= of_window[w]
        hit = sum(covered(len(words), spans))
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(words), hit, len(ids), sha(",".join(ids)), hit > 0))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = text or ""
    words = solid(text)
    lines = [line for line in text.split("\n") if SOLID.search(line)]
    seen = Counter(windows(words, 5))
    repeat = sum(covered(len(words), [(i, i + 5) for i, w in enumerate(windows(words, 5)) if seen[w] > 1]))
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat,
        len(words) < 10 or 100 * repeat > 20 * len(words),
    )


def license_of(text, templates, threshold):
    """The most alike template and its likeness over lines, paragraphs and the whole text."""
    def bigrams(t):
        words = plain(t)
        return set(zip(words, words[1:]))

    text = text or ""
    lines = text.split("\n")
    paragraphs, part = [], []
    for line in [*lines, ""]:
        if SOLID.search(line):
            part.append(line)
        else:
            paragraphs.append("\n".join(part))
            part = []
    best = (0.0, None)
    for unit in [*lines, *paragraphs, text]:
        mine = bigrams(unit)
        for name in sorted(templates):
            other = bigrams(templates[name])
            if mine:
                dice = 2 * len(mine & other) / (len(mine) + len(other))
                if dice >= threshold and (best[1] is None or (-dice, name) < (-best[0], best[1])):
                    best = (dice, name)
    return best[1], best[0]


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Target of every source, reshared until none is above its bound."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = budget - sum(fixed.values())
        total = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / total > most * sizes[s]]
        if not over:
            return fixed | {s: rest * weight[s] / total for s in free}
        fixed |= {s: most * sizes[s] for s in over}


def fair_queue(rows, grain=1000, least=32, weights=(3, 1, 2), share=1.5, most=2.0):
    """Words taken of every row by key, from (key, source, size, rank): all queue entries by virtual finish, cut at the budget."""
    sizes, queues = Counter(), defaultdict(list)
    for key, source, size, rank in rows:
        sizes[source] += size
        queues[source].append((rank, key, size))
    goal = targets(dict(sizes), weights, share, most) if rows else {}
    order = sorted((s for s in goal if s is not None), key=lambda s: s.encode()) + [s for s in goal if s is None]
    entries = []
    for place, source in enumerate(order):
        goal_, at = goal[source], 0
        for n in range(max(1, -(-goal_ // sizes[source]).__trunc__()) if sizes[source] else 0):
            for rank, key, size in sorted(queues[source]):
                packet = max(-(-goal_ // grain).__trunc__(), least) if at < 2 * goal_ else max(size, 1)
                for k, first in enumerate(range(0, size, packet)):
                    end = min(size, first + packet)
                    entries.append(((at + end) / goal_, place, rank, key, n, k, end - first))
                at += size
    left, taken = -(-sum(goal.values()) // 1).__trunc__(), {key: 0 for key, *_ in rows}
    for *_, key, _, _, words in sorted(entries):
        taken[key] += min(words, left)
        left -= min(words, left)
    return goal, taken
