"""Plain versions of the operators, one document after the other."""

import hashlib
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, words=4):
    found = WORD.findall((text or "").translate(LOWER))
    if 0 < len(found) < words:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def linked(docs, threshold=85, words=4):
    """docs: {id: text}. {id: (size of the set, component)}."""
    sets = {k: shingles(t, words) for k, t in docs.items()}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    lists = {}
    for k, s in sets.items():
        for one in s:
            lists.setdefault(one, []).append(k)
    pairs = {(a, b) for members in lists.values() for a in members for b in members if a < b}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= threshold * (len(sets[a]) + len(sets[b]) - common):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {k: (len(sets[k]), find(k)) for k in sets}


def cut(docs, window=50):
    """docs: {id: text}. {id: (bytes, removed, spans, what is left)}."""
    seen, found = set(), {}
    for k in sorted(docs):
        data = (docs[k] or "").encode()
        own = [data[i : i + window] for i in range(len(data) - window + 1)]
        gone = np.zeros(len(data), dtype=bool)
        for i, one in enumerate(own):
            if one in seen:
                gone[i : i + window] = True
        seen.update(own)
        spans = int((gone & ~np.append(False, gone[:-1])[: len(gone)]).sum())
        found[k] = (len(data), int(gone.sum()), spans, bytes(b for b, g in zip(data, gone) if not g))
    return found


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(number))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def personal(text):
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(found)


def crc(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def quality_statistics(text, stop_words):
    """The statistics that the rules of the quality score look at."""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    repeated = {i + k for i, one in enumerate(windows) if counts[one] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    letters, n, n_lines = sum(map(len, words)), max(len(words), 1), max(len(lines), 1)
    return {
        "words": float(len(words)),
        "word_length": letters / n,
        "symbols": len(re.findall("[#*$%&|<>]", text)) / n,
        "stop_words": sum(word in stop_words for word in words) / n,
        "repeated_lines": (len(lines) - len(set(lines))) / n_lines,
        "repeated_words": len(repeated) / n,
        "shouts": len(re.findall("[!?]", text)) / n,
        "stops": text.count(".") / n,
        "capitals": sum(unicodedata.category(c) == "Lu" for c in text) / max(letters, 1),
        "line_words": len(words) / n_lines,
    }
