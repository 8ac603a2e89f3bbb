"""Plain versions of the operators' contracts, row by row and all pairs, and the fixtures that tests share."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Null, empty, blank and very long texts, ties, repeated rows, null ids and sources, and columns of clashing names.
LONG = "lorem ipsum dolor sit amet consectetur " * 20_000
ODD = [
    (1, None, "en", "a", 7), (2, "", "en", "a", 7), (3, " \n\t ", None, None, None), (4, LONG, "de", "b", 1),
    (5, "one two", "en", "a", 2), (5, "one two", "en", "a", 2), (6, "ONE two", "fr", None, 3), (None, "one two three four", "en", "a", 3),
    (None, None, None, None, None), (7, "日本語 テキスト 'S x\u00a0y ΣΑΣ 12²", "ja", "b", 4), (8, "x" * 50_000, "en", "b", 4), (9, "12 34 | ## $$", "en", "", 4),
]
ODD_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, items string, row string, band string, kept string, score string, component_id string"


def odd(spark):
    return spark.createDataFrame([(*r, 0, "i", "r", "b", "k", "s", "c") for r in ODD], ODD_COLUMNS)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def remainder(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


def base_measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def base_secrets(text):
    text, found = text or "", []
    kinds = [
        (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ]
    for order, (kind, (pattern, good)) in enumerate(zip(("assign", "access", "hex"), kinds)):
        found += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text) if good(m)]
    listed = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))
    n = Counter(kind for _, _, kind, _ in found)
    return n["assign"], n["access"], n["hex"], hashlib.sha256(listed.encode()).hexdigest(), listed


def shingles(text, width):
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def components(rows, width, percent):
    """{doc_id: (size, component)} over all pairs."""
    sets, root = {}, {}
    for doc_id, text in rows:
        sets.setdefault(doc_id, []).append(shingles(text, width))
        root[doc_id] = doc_id

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in itertools.combinations([(i, s) for i, each in sets.items() for s in each], 2):
        both = len(x & y)
        if x and y and 100 * both >= percent * len(x | y):
            a, b = sorted((top(a), top(b)))
            root[b] = a
    return {i: top(i) for i in root}


def contamination(text, items, width=10):
    """n_words, n_hit, ids of the items that occur."""
    words = ITEM_WORD.findall(lower(text))
    hit, found = set(), set()
    for item, body in items:
        own = ITEM_WORD.findall(lower(body))
        n = min(width, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


def token_rows(rows):
    """{doc_id: (start, n, crc)} in ascending doc_id order."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = {}, 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out[doc_id] = (start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        start += len(ids)
    return out


def address(url):
    """host, path."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return lower(host), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def templates(rows, depth, min_tokens, min_docs, min_fixed, min_later=0.6):
    """{(doc_id, text): numbers of the lines that go}, by the tree's definition."""
    lines = {}
    for doc in set(rows):
        for n, line in enumerate((doc[1] or "").split("\n")):
            tokens = tuple("<*>" if re.search("[0-9]", t) else t for t in WORD.findall(line))
            if len(tokens) >= min_tokens:
                lines[doc, n] = tokens
    leaf = lambda t: (len(t), t[:depth])
    pairs = {(doc, tokens) for (doc, _), tokens in lines.items()}
    support = Counter((leaf(t), i, w) for _, t in pairs for i, w in enumerate(t) if i >= depth and w != "<*>")
    rung = lambda t, i: (support[leaf(t), i, t[i]] // min_docs).bit_length()

    def at(t, step):
        """The template of a line at a step; None if it is not mostly fixed."""
        made = tuple(w if i < depth or rung(t, i) >= step else "<*>" for i, w in enumerate(t))
        kept = sum(w != "<*>" for w in made[depth:])
        fixed = kept + sum(w != "<*>" for w in made[:depth])
        return made if fixed >= min_fixed * len(t) and kept >= min_later * sum(w != "<*>" for w in t[depth:]) else None

    def recurring(found):
        """Of {(doc, tokens): templates}, the pairs with a template that enough documents have."""
        docs = {}
        for (doc, _), made in found.items():
            for m in made - {None}:
                docs.setdefault(m, set()).add(doc)
        return {p for p, made in found.items() if any(len(docs[m]) >= min_docs for m in made - {None})}

    fine = recurring({(doc, t): {at(t, 1)} for doc, t in pairs})
    top = lambda t: max([rung(t, i) for i in range(depth, len(t))], default=0) + 1
    good = fine | recurring({(doc, t): {at(t, step) for step in range(1, top(t) + 1)} for doc, t in pairs - fine})
    out = {}
    for (doc, n), t in lines.items():
        if (doc, t) in good:
            out.setdefault(doc, set()).add(n)
    return out
