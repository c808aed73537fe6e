"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import collections
import math
import re
import zlib


def roots(ids, links):
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        root[high] = low
    return {i: top(i) for i in ids}


def labelled_runs(text, k=5):
    """Runs of k words with the number of their occurrence, in text order."""
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    runs = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) > k else [tuple(words)] * bool(words)
    seen, out = {}, []
    for run in runs:
        seen[run] = seen.get(run, 0) + 1
        out.append((run, seen[run]))
    return out


def longest_common(a, b):
    """Length of the longest common subsequence of two lists, by the plain recurrence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def document_classes(rows, least=0.8):
    """Classes over all pairs whose runs overlap enough, by Jaccard with the same order of runs."""
    runs = {i: labelled_runs(t) for i, t in rows}
    sets = {i: set(r) for i, r in runs.items()}
    ids = [i for i, r in runs.items() if r]
    links = []
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small < least * large:
                continue
            common = len(sets[a] & sets[b])
            if common < least * (small + large - common):
                continue
            x, y = runs[a], runs[b]
            matched = len(x) if x == y else longest_common([r for r in x if r in sets[b]], [r for r in y if r in sets[a]])
            if matched >= least * (len(x) + len(y) - matched):
                links.append((a, b))
    return roots([i for i, _ in rows], links), links


def missed_links(links, classes):
    return [(a, b) for a, b in links if classes[a] != classes[b]]




def one_edit(a, b):
    """Whether one code point inserted, deleted or replaced makes the other word."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    same = 0
    while same < len(a) and a[same] == b[same]:
        same += 1
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def spelling_variants(counts, ratio=10):
    """word -> (form, root, n, n_near, form_n), all words compared with all."""
    by_length = {}
    for word in counts:
        by_length.setdefault(len(word), []).append(word)
    near = {w: [] for w in counts}
    for w in counts:
        for size in (len(w) - 1, len(w), len(w) + 1):
            near[w] += [x for x in by_length.get(size, []) if one_edit(w, x)]
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def damaged_words(rows, damage=31):
    """Counts of the words of (doc_id, text), with the letters that op12 deletes."""
    counts = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def hard_negatives(rows, asked, scale=256, most=5, percent=80):
    """Sorted results for (vec_id, label, vector) rows that take part, every anchor against every row."""
    whole = [(i, label, [math.floor(scale * x) for x in v]) for i, label, v in rows]
    out = []
    for a, label, v in {(i, x, tuple(v)) for i, x, v in whole if asked(i)}:
        scored = [(sum(x * y for x, y in zip(v, w)), i, own == label) for i, own, w in whole if i != a]
        ranked = sorted(scored, key=lambda s: (-s[0], s[1]))
        for top, positive, _ in [s for s in ranked if s[2]][:most]:
            fits = [s for s in ranked if not s[2] and percent * top <= 100 * s[0] <= 100 * top]
            out += [(a, positive, n, i, top, score) for n, (score, i, _) in enumerate(fits[:most], 1)]
    return sorted(out)


def kneser_ney(texts, order=4, unseen=1 / 65536):
    """A function (context, character) -> probability of an interpolated Kneser-Ney model of lists of characters, the
    contexts being tuples of order - 1 characters; by the definition, with sets and counters."""
    counts = {order: collections.Counter()}
    for chars in texts:
        padded = (1,) * (order - 1) + tuple(chars)
        for i in range(len(chars)):
            counts[order][padded[i : i + order]] += 1
    for n in range(order - 1, 0, -1):
        counts[n] = collections.Counter(gram[1:] for gram in counts[n + 1])

    def probability(context, char, n=order):
        if n == 0:
            return unseen
        context = context[len(context) - (n - 1) :] if n > 1 else ()
        following = {g[-1]: c for g, c in counts[n].items() if g[:-1] == context}
        lower = probability(context, char, n - 1)
        if not following:
            return lower
        values = list(counts[n].values())
        ones, twos = values.count(1), values.count(2)
        discount = min(0.95, max(0.1, ones / max(1, ones + 2 * twos)))
        total = sum(following.values())
        return max(following.get(char, 0) - discount, 0) / total + discount * len(following) / total * lower

    return probability


def without_common_lines(rows, least_chars=20, least_docs=3):
    """Texts of (doc_id, text) rows without the lines that many documents share, except in the largest doc_id."""

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    held = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                held.setdefault(key(line), set()).add(doc)
    common = {k: max(docs) for k, docs in held.items() if len(docs) >= least_docs}
    out = []
    for doc, text in rows:
        kept = [x for x in (text or "").split("\n") if common.get(key(x), doc) == doc]
        out.append((doc, text if text is None else "\n".join(kept)))
    return out
