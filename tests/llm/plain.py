"""Plain Python versions that the Spark operators are checked against, and tables with awkward rows."""

import hashlib
import re

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = (
    "the river and its banks were quiet in that year as few boats came by with grain or wine for the town "
    "on market days so that people walked along it to see what was left of old mills and bridges from before "
    "when trade had been good and houses stood close to water under tall trees by an inn where a road turned"
).split()


def text_of(seed: int, n: int) -> str:
    """``n`` words that differ from seed to seed."""
    return " ".join(WORDS[(seed * 7 + i * (seed % 5 + 1) + i * i * seed) % len(WORDS)] + ("" if i % 3 else str((seed + i) % 97)) for i in range(n))


def awkward():
    """Nulls in every column, empty and blank texts, ties, repeated rows, a long text, a hot source."""
    base = text_of(1, 120)
    rows = [
        (1, base, "en", "src0", len(base)),
        (2, base, "en", "src0", len(base)),
        (2, base, "en", "src0", len(base)),
        (3, base + " and one more", None, "src1", None),
        (4, None, "en", None, 0),
        (5, "", "en", "src2", 0),
        (6, " \t\n\x0b\x0c\r ", None, "", 5),
        (7, "two words", "en", "src0", 9),
        (8, "two words", "en", "unknown", 9),
        (None, text_of(2, 80), "en", "src0", 1),
        (None, base, None, None, None),
        (9, "a@b.co +1 (826) 555-4081 190.137.223.2 4539578763621486", "de", "src3", 50),
        (10, " ".join(text_of(s, 300) for s in range(40)), "en", "src0", 1),
        (11, "the same line\n" * 60, "en", "src0", 1),
        (12, "é ö 日本 🙂 " * 40 + "x@y.org.", "fr", "src0", 1),
        (13, "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" ### here", "en", "src0", 1),
    ]
    return rows + [(20 + i, text_of(i + 3, 60 + i), "en", "src0" if i % 3 else f"src{i % 20}", 1) for i in range(40)]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, width):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = words_of(lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def near_duplicates(rows, width, percent):
    """``(doc_id, n_shingles, component, kept)`` by comparing all pairs; ids must be given and unique."""
    sets = {d: shingles(t, width) for d, t in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                one, two = find(a), find(b)
                root[max(one, two)] = min(one, two)
    return sorted((d, len(sets[d]), find(d), find(d) == d) for d in ids)


def quality(text):
    words = words_of(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    held = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if words_of(line)]
    counts = (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(held),
    )
    return (*counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0])


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 9 <= len(digits) <= 15
            ):
                out.append((kind, m.start(), m.end()))
    return out


def span_text(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def host_and_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path, rules):
    fits = [
        (len(h + p), h + p, action)
        for action, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)
