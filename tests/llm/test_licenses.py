import random
import re
from math import ceil

from demandlens.llm import licenses

WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLD = str.maketrans(licenses.UPPER, licenses.LOWER)


def split(text):
    return WORD.findall((text or "").translate(FOLD))


def plain(docs):
    """Every phrase at every place, every template against every line."""
    out = []
    for i, text in docs:
        own, at, labels, best = split(text), [], set(), 0.0
        for phrase, label in licenses.PHRASES.items():
            seek = phrase.split(" ")
            at += [(j, label) for j in range(len(own)) if own[j:j + len(seek)] == seek]
        for line in (text or "").split("\n"):
            for label, template in licenses.TEMPLATES.items():
                t = set(licenses.template_words(template))
                found = len(t & set(split(line)))
                if found >= ceil(licenses.SHARE * len(t)):
                    labels.add(label)
                    best = max(best, found / len(t))
        base = {x for _, x in at}
        out.append((i, len(own), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted(base)),
                    ",".join(sorted(base | labels)), 1.0 if at else best))
    return sorted(out, key=repr)


def test_equals_plain_version(spark):
    random.seed(8)
    extra = ["cc", "by", "CC-BY", "general", "public", "license", "All", "rights", "Reserved", "ccby", "über", "İ", "K", "\n", "."]
    docs = [(i, " ".join(random.choice(extra) for _ in range(random.randint(0, 60)))) for i in range(50)]
    for i, template in enumerate(licenses.TEMPLATES.values()):
        words = template.split(" ")
        for drop in (0, 1, 2, 4):
            left = [w for j, w in enumerate(words) if j not in random.sample(range(len(words)), min(drop, len(words)))]
            random.shuffle(left)
            docs.append((100 + 10 * i + drop, "intro\n" + " ".join(left).upper() + " and so on\nend " * random.randint(0, 2)))
    docs += [(1, None), (2, ""), (None, "CC BY"), (None, "CC BY"), (3, "all rights\nreserved cc by cc by cc"), (4, "x " * 5000 + "cc by")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as id", "2 as hash", "3 as matches")
    assert sorted((tuple(r) for r in licenses.digest(licenses.scan(df)).collect()), key=repr) == plain(docs)
    assert licenses.digest(licenses.scan(df.limit(0))).collect() == []
