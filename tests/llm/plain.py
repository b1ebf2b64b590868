"""Plain Python versions of what the operators compute, for small inputs."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def documents(spark, rows, extra=True):
    """A documents table of (doc_id, text) with its other columns, and some whose names the operators use inside."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    full = [(d, t, "en", "s", None if t is None else len(t)) for d, t in rows]
    if extra:
        schema += ", text_key string, row int, score string, digest string, `_digest` int, node int, words string, label int"
        full = [(*r, "x", 1, "y", "z", 2, 3, "w", 4) for r in full]
    return spark.createDataFrame(full, schema)


def near(docs, items, size, slop):
    """(doc_id, item_id, start) -> least words between the words of a window, by trying every place and going on greedily."""
    out = {}
    for item_id, text in items:
        term = words(text)
        k = min(size, len(term))
        for doc_id, body in docs if item_id is not None and term else []:
            own = words(body)
            for s, start in ((s, p) for s in range(len(term) - k + 1) for p in range(len(own)) if own[p] == term[s]):
                at = start
                for w in term[s + 1 : s + k]:
                    at = next((q for q in range(at + 1, len(own)) if own[q] == w), len(own) + slop + k)
                apart = at - start + 1 - k
                if apart <= slop:
                    key = (doc_id, str(item_id), start)
                    out[key] = min(apart, out.get(key, apart))
    return out


def contaminated(docs, items, size=13, one_in=20):
    wins = []
    for item_id, text in items:
        own = words(text)
        if item_id is not None and own:
            k = min(size, len(own))
            wins += [(str(item_id), tuple(own[i : i + k])) for i in range(len(own) - k + 1)]
    out = []
    for doc_id, text in docs:
        own, hit, ids = words(text), set(), set()
        for item_id, win in wins:
            for p in range(len(own) - len(win) + 1):
                if tuple(own[p : p + len(win)]) == win:
                    hit.update(range(p, p + len(win)))
                    ids.add(item_id)
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(ids), digest, bool(hit) and one_in * len(hit) >= len(own)))
    return out


def grams(text, size=5):
    own = words(text)
    if not own:
        return None
    return frozenset(tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1)))


def similar(docs, size=5):
    """(doc_id, class_id, class_size, n_links, group_id) of documents with different ids, by comparing all sets."""
    of = {d: grams(t, size) for d, t in docs}
    classes = defaultdict(list)
    for d, s in of.items():
        if s is not None:
            classes[s].append(d)
    sets = list(classes)
    links = {s: [r for r in sets if r != s and 5 * len(r & s) >= 4 * len(r | s)] for s in sets}
    out = []
    for d, s in of.items():
        if s is None:
            out.append((d, d, 1, 0, d))
            continue
        seen, todo = {s}, [s]
        while todo:
            for r in links[todo.pop()]:
                if r not in seen:
                    seen.add(r)
                    todo.append(r)
        out.append((d, min(classes[s]), len(classes[s]), len(links[s]), min(min(classes[r]) for r in seen)))
    return out
