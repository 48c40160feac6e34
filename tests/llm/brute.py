"""Plain-loop versions of the operators, for small inputs."""



import math
import re

import numpy as np

from quirelight.llm.text_hash import Ranges

LOWERED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def word_hash(word: bytes) -> int:
    return int(Ranges(np.frombuffer(word.translate(LOWERED), np.uint8)).of(np.array([0]), np.array([len(word)]))[0])


def sentences(text: bytes, long: int = 24) -> list[tuple[int, int]]:
    """Each sentence's first byte and number of words, word by word."""
    found = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
    runs, run = [], []
    for k, (a, b) in enumerate(found):
        run.append((a, b))
        if k + 1 == len(found) or text[b - 1 : b] in (b".", b"!", b"?") or b"\n" in text[b : found[k + 1][0]]:
            runs.append(run)
            run = []
    out = []
    for run in runs:
        part = []
        for a, b in run:
            part.append(a)
            if len(run) > long and word_hash(text[a:b]) % 8 == 0:
                out.append((part[0], len(part)))
                part = []
        if part:
            out.append((part[0], len(part)))
    return out


def sentence_dedup(texts: dict[int, str | None], least: int = 2, min_words: int = 16) -> dict[int, str]:
    cut, first, seen = {}, {}, []
    for d in sorted(texts):
        text = (texts[d] or "").encode()
        own = sentences(text)
        byte, size = [a for a, _ in own], np.array([n for _, n in own], np.int64)
        keys = [text[a:b].lower().split() for a, b in zip(byte, [*byte[1:], len(text)], strict=True)]
        cut[d] = [0, *byte[1:], len(text)] if len(byte) else [0]
        found = set()
        for i in range(len(keys)):
            for j in range(i + least - 1, len(keys)):
                if size[i : j + 1].sum() >= min_words:
                    found.add((i, j))
                    break
            for j in range(i - least + 1, -1, -1):  # the shortest that ends here
                if size[j : i + 1].sum() >= min_words:
                    found.add((j, i))
                    break
        for i, j in sorted(found):
            key = tuple(w for s in keys[i : j + 1] for w in s)
            seen.append((key, d, i, j))
            first.setdefault(key, (d, i))
    gone = {d: set() for d in texts}
    for key, d, i, j in seen:
        if first[key] != (d, i):
            gone[d].update(range(i, j + 1))
    return {d: b"".join((texts[d] or "").encode()[a:b] for k, (a, b) in enumerate(zip(c[:-1], c[1:], strict=True)) if k not in gone[d]).decode() if len(c) > 1 else texts[d] or "" for d, c in cut.items()}


def suffix_dedup(texts: list[tuple[int, str | None]], length: int = 50) -> list[tuple[int, int, int, bytes]]:
    """Per row: doc_id, removed bytes, removed runs, kept bytes."""
    first: dict[bytes, int] = {}
    for d, t in sorted(texts, key=lambda x: x[0]):
        t = (t or "").encode()
        for i in range(len(t) - length + 1):
            first.setdefault(t[i : i + length], d)
    out = []
    for d, t in texts:
        t = (t or "").encode()
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < d:
                gone[i : i + length] = True
        out.append((d, int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), bytes(b for b, g in zip(t, gone) if not g)))
    return out


def every_run_dedup(texts: dict[int, str | None], least: int = 2, min_words: int = 16) -> dict[int, str]:
    """sentence_dedup() by all runs of the size, however long."""
    parts, first, seen = {}, {}, []
    for d in sorted(texts):
        text = (texts[d] or "").encode()
        cut = [0, *[a for a, _ in sentences(text)][1:], len(text)]
        parts[d] = [text[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        keys = [x.lower().split() for x in parts[d]]
        for i in range(len(keys)):
            for j in range(i + least - 1, len(keys)):
                key = tuple(w for s in keys[i : j + 1] for w in s)
                if len(key) >= min_words:
                    seen.append((key, d, i, j))
                    first.setdefault(key, (d, i))
    gone = {d: set() for d in texts}
    for key, d, i, j in seen:
        if first[key] != (d, i):
            gone[d].update(range(i, j + 1))
    return {d: b"".join(x for k, x in enumerate(p) if k not in gone[d]).decode() for d, p in parts.items()}


def suffix_tree(texts: list[list[str]], train: list[bool], depth: int, gain: float, discount: float) -> list[float]:
    """log10 probabilities by dictionaries: texts as words, each with its end."""
    grams: dict[tuple, int] = {}
    for ws, learn in zip(texts, train, strict=True):
        for k in range(1, depth + 2):
            for i in range(len(ws) - k + 1):
                grams[tuple(ws[i : i + k])] = grams.get(tuple(ws[i : i + k]), 0) + learn
    one = {g[0]: n for g, n in grams.items() if len(g) == 1 and n}
    total, once = sum(one.values()), sum(n == 1 for n in one.values())
    if not total:
        return [0.0] * len(texts)
    unknown = (once + 0.5) / (total + 1)
    root = lambda w: (1 - unknown) * one[w] / total if w in one else unknown
    after: dict[tuple, dict[str, int]] = {}
    for g, n in grams.items():
        if len(g) > 1 and n >= 2:
            after.setdefault(g[:-1], {})[g[-1]] = n
    kept = set()
    state = lambda c: len(c) == 1 or grams.get(c, 0) < grams.get(c[1:], 0)
    for c, found in after.items():
        n = grams[c]
        if not state(c):
            continue
        before = {w: root(w) if len(c) == 1 else grams[(*c[1:], w)] / grams[c[1:]] for w in found}
        rest = n - sum(found.values())
        divergence = sum(x * math.log(x / (n * before[w])) for w, x in found.items())
        if rest:
            divergence += rest * math.log(rest / n / max(1e-9, 1 - min(1, sum(before.values()))))
        if divergence - len(found) * (1 + 0.5 * math.log(n)) >= gain:
            kept.add(c)

    def p(c: tuple, w: str) -> float:
        if not c:
            return root(w)
        n, found = grams.get(c, 0), after.get(c, {})
        if not state(c):
            return p(c[1:], w)
        left = (n - sum(found.values()) + discount * len(found)) / n
        return (found[w] - discount if w in found else 0) / n + left * p(c[1:], w)

    out = []
    for ws in texts:
        score = 0.0
        for i, w in enumerate(ws):
            contexts = [tuple(ws[i - d : i]) for d in range(min(depth, i), 0, -1)]
            score += math.log10(p(next((c for c in contexts if c in kept), ()), w))
        out.append(score)
    return out


def clause(classes: list) -> np.ndarray:
    """A clause's weights by state, by looking around each insult and threat."""
    out = np.zeros(8)
    for i, x in enumerate(classes):
        if x.__class__ is float or x == "threat":
            near = classes[max(0, i - 3) : i] + classes[i + 1 : i + 4]
            aimed = "target" in near
            if x != "threat" or aimed:
                out[("negation" in classes[max(0, i - 3) : i]) + 2 * ("reported" in classes[:i]) + 4 * aimed] += 4.0 if x == "threat" else x
    return out


def least_determinant(x: np.ndarray, share: float, floor: float, starts: int = 60, seed: int = 0) -> tuple[float, np.ndarray]:
    """Log determinant of the covariance (with the floor) of the best subset found by concentration from many random
    subsets, and all rows' squared distances by it."""
    rng, h, best = np.random.default_rng(seed), math.ceil(share * len(x)), None
    for _ in range(starts):
        at = rng.choice(len(x), x.shape[1] + 3, replace=False)
        for _ in range(30):
            centre, spread = x[at].mean(axis=0), np.cov(x[at].T, bias=True) + floor * np.eye(x.shape[1])
            d2 = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(spread), x - centre)
            at = np.argsort(d2, kind="stable")[:h]
        centre, spread = x[at].mean(axis=0), np.cov(x[at].T, bias=True) + floor * np.eye(x.shape[1])
        if best is None or np.linalg.slogdet(spread)[1] < best[0]:
            best = np.linalg.slogdet(spread)[1], np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(spread), x - centre)
    return best
