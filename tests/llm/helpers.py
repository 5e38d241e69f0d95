"""Small tables with the hard cases, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re
import zlib

from pyspark.sql import DataFrame

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(*texts, first: int = 0, source=None):
    """Documents with ascending ids; ``source`` may be a function of the id."""
    pick = source or (lambda i: f"src{i % 3}")
    return [(i, t, "en", pick(i), len(t) if t is not None else None) for i, t in enumerate(texts, first)]


def table(spark, found, schema: str = SCHEMA) -> DataFrame:
    return spark.createDataFrame(found, schema)


def prose(seed: int, words: int) -> str:
    pick = random.Random(seed)
    made = lambda: "".join(pick.choice("abcdefghijklmnoprstuvw") for _ in range(pick.randint(2, 9)))
    out = []
    for i in range(words):
        out.append(made().capitalize() + "." if i % 11 == 10 else made())
    return re.sub(r"\. ", lambda _: ".\n" if pick.random() < 0.3 else ". ", " ".join(out))


def hard_rows():
    """Nulls in any column, empty, blank and long texts, odd characters, ties and repeated rows."""
    long = prose(1, 3000)
    texts = [long, prose(2, 300), "", "   \n\t ", None, "one", "#*$%&|<> ###", "a\x00b éè中 \U0001f600 word word  two   spaces \n x", prose(2, 300), long + " tail"]
    found = rows(*texts)
    found += [(20, prose(3, 80), None, None, None), (21, None, None, None, None), (None, prose(4, 60), "en", "src1", 5), (None, None, None, None, None)]
    found += [(30, prose(5, 50), "de", "src2", 9)] * 3 + [(31, prose(6, 40), "en", "z", 1), (31, prose(7, 40), "en", "z", 1)]
    return found


def with_clashes(df: DataFrame) -> DataFrame:
    """The same table with further columns named as operators might name theirs."""
    from pyspark.sql import functions as F

    names = "version key bucket part size rank block n lines raw starts h fingerprint content tokens class digest _id _v _row _copy _n words".split()
    return df.select("*", *[F.lit(f"x{n}").alias(n) for n in names])


def crc_of(ids) -> int:
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))
