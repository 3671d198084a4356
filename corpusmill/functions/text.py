"""Column expressions on text: emptiness, bytes, segments."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
PAD_ID = 0
UNK_ID = 1
EOS_ID = 2
CONTROL_PIECES = ("<pad>", "<unk>", "</s>")
USER_SYMBOLS = ("<|im_start|>", "<|im_end|>", "<|pad|>")
FIRST_BYTE_ID = 6  # three control pieces and three user symbols come first
FIRST_MERGE_ID = 262  # 6 + 256 byte pieces
WORD_MARK = "▁"  # stands for a space inside pieces
EOS_BYTE = 255  # stands for EOS among the bytes of texts
MAX_TOKEN_ID = 65535  # ids are stored as unsigned 16-bit
# ----------------------------------------------------------------------------


def is_non_empty(text: Column) -> Column:
    """Neither null nor ''; text of spaces only is kept."""
    return text.isNotNull() & (text != "")


def utf8_length(text: Column) -> Column:
    return F.octet_length(text)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _byte_ids(part: pa.Array, eos_id: pa.Array) -> pa.Array:
    ids = np.arange(FIRST_BYTE_ID, FIRST_BYTE_ID + 256, dtype=np.int32)
    ids[EOS_BYTE] = eos_id[0].as_py() if len(eos_id) else EOS_ID
    part = part.cast(pa.large_binary())
    _, offsets, data = part.buffers()
    offsets = np.frombuffer(offsets, np.int64)[part.offset : part.offset + len(part) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    starts = pa.array((offsets - offsets[0]).astype(np.int32))
    return pa.ListArray.from_arrays(starts, pa.array(ids[raw]), mask=part.is_null() if part.null_count else None)


def byte_ids(part: Column, eos_id: int = EOS_ID) -> Column:
    """Ids of bytes: 6 + each byte, and EOS for the byte 255, which no UTF-8 text holds."""
    return _byte_ids(part, F.lit(eos_id))


def byte_tokens(text: Column) -> Column:
    """Byte-fallback ids of a text: 6 + each UTF-8 byte."""
    return byte_ids(F.encode(text, "UTF-8"))


def text_stream(text: Column) -> Column:
    """The UTF-8 bytes of a text and one of EOS, for :func:`byte_ids`."""
    return F.concat(F.encode(text, "UTF-8"), F.lit(bytes([EOS_BYTE])))


def with_eos(tokens: Column, eos_id: int = EOS_ID) -> Column:
    return F.concat(tokens, F.array(F.lit(eos_id)))


def marked(text: Column) -> Column:
    """Dummy prefix added, every space replaced by the word mark."""
    return F.concat(F.lit(WORD_MARK), F.replace(text, F.lit(" "), F.lit(WORD_MARK)))
