"""Fill-in-middle transformation (operator 12) by ranks in a wavelet matrix.

A document is cut into prefix, middle and suffix at two places counted in units (characters, or words), drawn from a SHA-256 of the seed and its id, so reruns and any partitioning
agree. The texts of a slice become one wavelet matrix over character classes (``wavelet``): sums of
class ranks count each text's units, bisection on those sums locates both cuts of all texts at once.
The texts are never split into units; work arrays take some 10 bytes per byte of a slice, and a
slice holds 1 MB or one text.

Forms: plain is the text itself (empty texts, texts that contain a mark, and the plain share); psm
is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle; spm is ``<S>`` suffix ``<P>`` prefix ``<M>``
middle. As no cut text contains a mark and no mark overlaps itself, ``restore`` finds the parts by
splitting at the marks.

Null texts count as empty and are plain; a null id is drawn as an empty id. Repeated rows give equal
rows. Extra columns pass through, but for those named like a result. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import raw_bytes, slices
from .wavelet import WaveletMatrix, classes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, PLAIN_FROM, SPM_BELOW = 1, 90, 20
RESULTS = ["n", "form", "prefix_chars", "middle_chars", "output"]


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """The first four 8-digit groups of the hex SHA-256 of ``seed:doc_id``, as unsigned integers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _cutter(unit: str):
    marks = tuple(x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "__text"):
                data, at = raw_bytes(part.column("__text"))
                h = [part.column(f"__h{i}").to_numpy() for i in range(4)]
                begin, end = at[:-1], at[1:]
                matrix = WaveletMatrix(classes(data, at))
                n = matrix.boundaries(unit, end) - matrix.boundaries(unit, begin)
                cuts = np.sort([h[0] % (n + 1), h[1] % (n + 1)], axis=0)
                first, second = (matrix.locate(unit, begin, end, c) for c in cuts)
                chars = [matrix.boundaries("char", x) for x in (begin, first, second)]
                raw = data.tobytes()
                forms, outputs, plain = [], [], np.zeros(len(n), bool)
                for i, (a, x, y, b) in enumerate(zip(begin, first, second, end)):
                    text = raw[a:b]
                    plain[i] = a == b or h[2][i] % 100 >= PLAIN_FROM or any(m in text for m in marks)
                    spm = h[3][i] % 100 < SPM_BELOW
                    forms.append("plain" if plain[i] else "spm" if spm else "psm")
                    if plain[i]:
                        outputs.append(text)
                    else:
                        head, middle, tail = raw[a:x], raw[x:y], raw[y:b]
                        outputs.append(marks[1] + tail + marks[0] + head + marks[2] + middle if spm
                                       else marks[0] + head + marks[1] + tail + marks[2] + middle)
                new = [pa.array(n), pa.array(forms, pa.string()), pa.array(chars[1] - chars[0], mask=plain),
                       pa.array(chars[2] - chars[1], mask=plain), pa.array(outputs, pa.binary()).cast(pa.string())]
                keep = [c for c in part.schema.names if c != "__text" and c not in ("__h0", "__h1", "__h2", "__h3")]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *new], [*keep, *RESULTS])

    return cut


def transform(docs: DataFrame, unit: str = "char", seed: int = SEED) -> DataFrame:
    """All columns of ``docs(doc_id, text, ...)`` but text, plus n (units), form, prefix_chars, middle_chars, output."""
    keep = [c for c in docs.columns if c != "text" and c not in RESULTS]
    h = [x.alias(f"__h{i}") for i, x in enumerate(draws(F.col("doc_id"), seed))]
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("__text"), *h)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    schema = ", ".join([*fields, "n long", "form string", "prefix_chars long", "middle_chars long", "output string"])
    return rows.mapInArrow(_cutter(unit), schema)


def restore(output: Column, form: Column) -> Column:
    """The exact text, from output and form alone."""
    parts = F.split(output, "<[PSM]>", -1)
    at = lambda i: F.get(parts, F.lit(i))
    return (F.when(form == "plain", output)
            .when(form == "psm", F.concat(at(1), at(3), at(2)))
            .otherwise(F.concat(at(2), at(3), at(1))))
