import os
import random
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm_spark(spark):
    from goldenrec.llm.queries import ready

    ready(spark)
    return spark


def prose(rng: random.Random, words: int) -> str:
    stock = [a + b for a in ("the", "an", "er", "shon", "é", "ti") for b in ("ing", "la", "xu", "do", "ña", "")]
    lines = []
    while words > 0:
        n = min(words, rng.randint(3, 12))
        lines.append(" ".join(rng.choices(stock, k=n)).capitalize() + ".")
        words -= n
    return "\n".join(lines)


@pytest.fixture(scope="session")
def texts() -> list[str | None]:
    """Plain, copied, near-copied, empty, NULL, blank, odd and long texts."""
    rng = random.Random(7)
    plain = [prose(rng, rng.randint(1, 220)) for _ in range(40)]
    copies = [plain[3], plain[3], plain[5] + " more", plain[6].upper()]
    odd = [None, "", "", "   ", "\n\n", "a", "it's we'll 're 123 \t x\r\n", "<|endoftext|> two <|endoftext|>", "x" * 3000, " " * 700 + "end",
           "漢字 かな 😀 ́ ½ Ⅷ", "▁ mark", "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."]
    return plain + copies + odd + [prose(rng, 6000)]


@pytest.fixture(scope="session")
def docs(llm_spark, texts):
    rows = [(3 * k, t, "en", "s", None) for k, t in enumerate(texts)]
    return llm_spark.createDataFrame(rows, DOCS).repartition(3, "doc_id").cache()


@pytest.fixture()
def empty(llm_spark):
    return llm_spark.createDataFrame([], DOCS)
