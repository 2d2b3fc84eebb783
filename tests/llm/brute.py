"""Plain versions of what the operators do, and texts to try them on."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

WORDS = "the of and a river stone harbour Wind letter market garden window copper Train evening valley silver bridge ñandú été".split()


def prose(rng, n, endings=60):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, endings)) for _ in range(n))


def corpus(seed=1, n=40):
    """Documents with copies, edited copies, shared passages, repeats inside one text, and odd texts."""
    rng = random.Random(seed)
    passage, line = prose(rng, 90), prose(rng, 12)
    texts = [prose(rng, rng.randint(1, 160)) for _ in range(n)]
    for i in range(0, n, 5):
        words = texts[i].split(" ")
        words[len(words) // 2:len(words) // 2] = passage.split(" ")
        texts[i] = " ".join(words)
    texts += [texts[0], texts[0], texts[5].replace("river", "RIVER", 1), passage + "\n" + passage, None, "", "\n\n", "x", "ab " * 120]
    texts = [t if t is None or i % 4 else f"{line}\n{t}\n {line.upper()} \t" for i, t in enumerate(texts)]
    return [(i * 3 % (len(texts) * 3 + 1), t) for i, t in enumerate(texts)]


def cut_bytes(rows, length=100):
    """doc_id to (bytes, removed flags): strings that start earlier go."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if raw[i:i + length] in seen:
                gone[i:i + length] = [True] * length
            seen.add(raw[i:i + length])
        out[doc] = raw, gone
    return out


def cut_words(rows, length=50):
    """doc_id to (words, removed flags): windows that a smaller document has go."""
    first, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            if first.setdefault(tuple(words[i:i + length]), doc) < doc:
                gone[i:i + length] = [True] * length
        out[doc] = words, gone
    return out


def context_trees(rows, depth=5):
    """doc_id to (tokens, known, all, base, score) by dictionaries of counts and recursion."""
    counts, words, texts = defaultdict(lambda: [0, 0]), Counter(), {}
    for doc, text in rows:
        tokens = (text or "").encode().lower().split()
        line = b"\n" * depth + b" ".join(tokens) + b"\n"
        held = doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0
        texts[doc] = line, tokens
        if held:
            continue
        words.update([*tokens, None])
        for at in range(depth, len(line)):
            for bit in range(8):
                node = 1 << bit | line[at] >> 8 - bit
                for d in range(depth + 1):
                    counts[line[at - d:at], node][line[at] >> 7 - bit & 1] += 1
    lg = math.lgamma
    own = {k: lg(a + .5) + lg(b + .5) - math.log(math.pi) - lg(a + b + 1) for k, (a, b) in counts.items()}
    below, mixture = defaultdict(float), {}
    for key in sorted(counts, key=lambda k: -len(k[0])):
        mixture[key] = own[key]
        if len(key[0]) < depth:
            high, low = max(own[key], below[key]), min(own[key], below[key])
            mixture[key] = high + math.log1p(math.exp(low - high)) - math.log(2)
        if key[0]:
            below[key[0][1:], key[1]] += mixture[key]

    def one(context, node):
        chance = .5
        for d in range(depth, -1, -1):
            key = context[depth - d:], node
            if key in counts:
                a, b = counts[key]
                stop = 1 if d == depth else 1 / (1 + math.exp(min(700, below[key] - own[key])))
                chance = stop * (b + .5) / (a + b + 1) + (1 - stop) * chance
        return chance

    total, distinct = sum(words.values()), len(words)
    value = lambda w: math.log10((words[w] + .1) / (total + .1 * (distinct + 1)))
    out = {}
    for doc, (line, tokens) in texts.items():
        score = 0
        for at in range(depth, len(line)):
            for bit in range(8):
                chance = one(line[at - depth:at], 1 << bit | line[at] >> 8 - bit)
                score += math.log10(chance if line[at] >> 7 - bit & 1 else 1 - chance)
        all_tokens = [*tokens, None]
        out[doc] = len(all_tokens), sum(words[w] > 0 for w in all_tokens), total, sum(map(value, all_tokens)), score
    return out


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Make a documents table from (doc_id, text) or (doc_id, text, source) rows."""

    def make(*rows, schema=DOCS):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def saved(spark, tmp_path):
    """Write tables to a folder that queries read."""

    def save(**tables):
        for name, df in tables.items():
            df.withColumn("extra", F.lit("kept") if "extra" not in df.columns else F.col("extra")).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return save
