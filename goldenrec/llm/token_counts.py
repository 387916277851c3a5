"""Token counts by a compiled finite-state tokenizer (see ``transducer``).

Every text is read whole inside the task that scanned it: no shuffle, and
memory is bounded by a slice of texts (a longer text is a slice of its own).

NULL texts count as empty (0 bytes, 0 tokens). Rows are returned one for one:
repeated rows and NULL ids stay. Other columns of the input are not read, so
their names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from goldenrec.llm.text import id_and_text, slices
from goldenrec.llm.transducer import transducer


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs``.

    ``tokenizer_path`` is the byte-level BPE file, at the same path on every
    machine; special strings inside texts are special tokens, as is the
    library's default. ``over_limit`` is n_tokens > ``limit``.
    """
    rows = id_and_text(docs, id_col, text_col)

    def run(batches):
        machine = transducer(tokenizer_path)
        for batch in batches:
            for part in slices(batch, most=2 << 20):
                n = machine.count(part.column(1).to_pylist())
                size = pc.binary_length(part.column(1)).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), size, pa.array(n), pa.array(n > limit)],
                                                 ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
