"""Plain versions of the operators' rules, and rows that are awkward for them."""

import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NORMAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def crc(value) -> int:
    return zlib.crc32(str(value).encode())


def words(text) -> list[str]:
    return WORD.findall(text or "")


def awkward(spark, *, nulls: bool = True):
    """Null, empty, blank, long, tied and repeated texts, with extra columns that clash with results."""
    prose = " ".join(f"word{i * i % 97} of{i % 13}" for i in range(60))
    texts = [
        "", " \t\r\n ", "one", "a b c d", "a b c d e", "A B C D E", prose, prose, prose + " tail",
        "x " * 30_000, " ".join(f"w{i}" for i in range(20_000)), "é ü ß q 12 \u0085 z", "line one here\n" * 40, "<|endoftext|> it's",
        "ünï " * 300,
    ]
    rows = [(i, t, "en" if i % 2 else "de", f"s{i % 2}", len(t)) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6]]  # repeated rows
    if nulls:
        rows += [(100, None, "en", "s0", None), (101, None, None, None, None), (None, prose, None, None, 3), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    clashing = ["rules", "kept", "n_words", "dedup", "contamination", "row", "block", "data", "id", "score", "component_id", "_row", "kind"]
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(clashing)])


def empty(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text) -> frozenset:
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def near_groups(texts: dict, percent: int = 85) -> dict:
    """Smallest reachable id by brute force over all pairs."""
    sets = {k: shingles(v) for k, v in texts.items()}
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: root(k) for k in ids}


def without_repeats(rows: list[tuple], size: int = 20) -> list[tuple[int, list[str]]]:
    """(words, kept words) of texts in order; a window that started before loses its words."""
    seen, out = set(), []
    for _, text in rows:
        w = words(text)
        gone = set()
        for k in range(len(w) - size + 1):
            window = tuple(w[k : k + size])
            if window in seen:
                gone.update(range(k, k + size))
            seen.add(window)
        out.append((len(w), [x for j, x in enumerate(w) if j not in gone]))
    return out


def hits(text, items: dict, size: int = 10) -> tuple[int, set, list]:
    """Number of words, hit positions and ids of the items found."""
    w = NORMAL_WORD.findall((text or "").translate(LOWER))
    hit, found = set(), []
    for item, t in items.items():
        iw = NORMAL_WORD.findall((t or "").translate(LOWER))
        n = min(size, len(iw))
        windows = {tuple(iw[k : k + n]) for k in range(max(1, len(iw) - size + 1))} if iw else set()
        at = [k for k in range(len(w) - n + 1) if n and tuple(w[k : k + n]) in windows]
        if at:
            found.append(str(item))
        for k in at:
            hit.update(range(k, k + n))
    return len(w), hit, sorted(found)


def measured(text) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    count = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    rep = {k + j for k in range(len(w) - 2) if count[tuple(w[k : k + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(rep)
