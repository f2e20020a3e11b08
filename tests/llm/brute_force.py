"""Plain versions of the operators, written from their definitions."""

import re
from collections import Counter, defaultdict


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def grams(text, k):
    found = words(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not found:
        return set()
    return {tuple(found[i:i + k]) for i in range(max(1, len(found) - k + 1))}


def components(docs, k, num, den):
    """(doc_id, text) rows -> {doc_id: (set size, smallest id reachable)}; ids are unique."""
    sets = {i: grams(t, k) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def lines_kept(docs, min_chars):
    """Rows (doc_id, text), ids unique -> {doc_id: text}: a line goes if an earlier one is equal or, if long, within one edit."""
    seen, out = [], {}
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        kept = []
        for line in (t or "").split("\n"):
            norm = line.strip(" \t\v\f\r")
            if not norm:
                kept.append(line)
                continue
            if norm not in seen and not any(min(len(norm), len(o)) >= min_chars and abs(len(norm) - len(o)) <= 1
                                            and distance(norm, o) <= 1 for o in seen):
                kept.append(line)
            seen.append(norm)
        out[i] = None if t is None else "\n".join(kept)
    return out


def quality(docs, max_docs=20, max_share=0.01, max_removed=0.8):
    """Rows (doc_id, text, host), ids unique -> {doc_id: (counts..., removed words, base_failed, kept, text)}."""
    def norm(line):
        return re.sub("[0-9]", "0", " ".join(words(line.lower())))
    texts, first, size = defaultdict(set), {}, defaultdict(set)
    for i, t, host in sorted(docs, key=lambda d: d[0]):
        size[host].add(t or "")
        for line in (t or "").split("\n"):
            if words(line):
                texts[host, norm(line)].add(t)
                first.setdefault((host, norm(line)), i)
    frequent = {k for k, v in texts.items() if len(v) > max_docs and len(v) > max_share * len(size[k[0]])}
    out = {}
    for i, t, host in docs:
        w, lines = words(t), (t or "").split("\n")
        grams5 = Counter(tuple(w[j:j + 5]) for j in range(len(w) - 4))
        covered = {j + d for j in range(len(w) - 4) if grams5[tuple(w[j:j + 5])] > 1 for d in range(5)}
        with_word = [x for x in lines if words(x)]
        gone = [n for n, x in enumerate(lines) if words(x) and (host, norm(x)) in frequent and first[host, norm(x)] != i]
        removed = sum(len(words(lines[n])) for n in gone)
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        out[i] = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(with_word) - len(set(with_word)), len(covered),
                  removed, failed, not failed and removed <= max_removed * len(w),
                  t if not gone else "\n".join(x for n, x in enumerate(lines) if n not in gone))
    return out
