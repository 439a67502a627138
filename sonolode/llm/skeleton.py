"""Problem 5: one form for texts that look alike, by a confusables skeleton.

The skeleton of a text is found by canonical decomposition, replacement of every character by the prototype of
its look-alikes, and decomposition again; texts that look the same have equal skeletons. The prototypes keep
case, tone marks, under-dots, hooks and punctuation apart, so that texts that look different stay different.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other alphabets (or other code points) with the shape of a Latin letter, and that letter. Letters that merely
# resemble one in some fonts are left apart; a Greek alpha, iota, upsilon, gamma, eta or phi has the shape of the Latin letter of
# that name (ɑ ɩ ʋ ɣ ƞ ɸ), which these languages tell apart from a, i, u, y, n and o.
_SHAPES = {
    # Cyrillic
    "АВЕКМНОРСТУХІЈЅЅԚԜӀҮҺԌӘӨӠӔѴԐ": "ABEKMHOPCTYXIJSSQWIYhGƏƟƷÆVƐ",
    "аеорсухіјѕԁһԛԝӏүѵәөӡӕԑкԍ": "aeopcyxijsdhqwlyvəɵʒæɛĸɢ",
    # Greek
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϽΣΛͿ": "ABEZHIKMNOPTYXCƆƩɅJ",
    "ονρεϲϳͻαιυγηφκ": "ovpɛcjɔɑɩʋɣƞɸĸ",
    # Armenian
    "ՕՍԼՏօսոհցյ": "OULSounhgȷ",
    # Cherokee
    "ᎠᎡᎢᎩᎪᎫᎬᎳᎷᎻᏀᏃᏒᏔᏙᏚᏞᏟᏢᏦᏴ": "DRTYAJEWMHGZRWVSLCPKB",
    "ᎥᏏᏧ": "ibd",
    # Lisu
    "ꓐꓑꓓꓔꓖꓗꓙꓚꓛꓜꓝꓟꓠꓡꓢꓣꓥꓦꓧꓪꓫꓬꓮꓰꓱꓲꓳꓴ": "BPDTGKJCƆZFMNLSRɅVHWXYAEƎIOU",
    # Coptic
    "ⲂⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲌ": "BHIKMNOPCTYXZ",
    "ⲟⲣⲥⲭ": "opcx",
    # small capitals with the shape of the small letter, and Latin letters with one shape
    "ᴄᴏᴠᴡᴢꜱᴐ": "covwzsɔ",
    "ɡÐĐǝↄↃ": "gƉƉəɔƆ",
}
# Signs that all show as an apostrophe.
_APOSTROPHES = "‘’‛ʼʻʽˈʹ′＇ꞌ՚"
# Characters outside category Cf that show nothing.
_INVISIBLE = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
#: Compatibility forms that differ from their letters in width, font or joining only.
_SAME_LOOK = {"<wide>", "<narrow>", "<font>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>"}


def prototype(ch: str) -> str:
    """What stands for the single character ``ch`` in a skeleton."""
    if ord(ch) in _INVISIBLE:
        return ""
    kind = unicodedata.category(ch)
    if kind == "Cf":
        return ""
    if kind == "Zs" or ch in "\t\x0b\x0c\x1c\x1d\x1e\x1f":
        return " "
    if ch in "\x85\u2028\u2029\r":
        return "\n"
    if ch in _APOSTROPHES:
        return "'"
    tag, _, rest = unicodedata.decomposition(ch).partition(" ")
    if tag.startswith("<"):
        letters = "".join(chr(int(x, 16)) for x in rest.split())
        # joined letters, and Roman numbers, which are category Nl
        if tag in _SAME_LOOK or tag == "<compat>" and (len(letters) > 1 and kind[0] == "L" or kind == "Nl") and all(unicodedata.category(x)[0] == "L" for x in letters):
            return "".join(prototype(x) for x in unicodedata.normalize("NFD", letters))
    return ch


class _Table(dict):
    def __missing__(self, code: int) -> str:
        self[code] = out = prototype(chr(code))
        return out


_TABLE = _Table({ord(a): b for shapes, to in _SHAPES.items() for a, b in zip(shapes, to, strict=True)})


def skeleton(text: str | None) -> str | None:
    """The skeleton of ``text``; null for null, empty for a text of which nothing shows."""
    if text is None:
        return None
    if text.isascii() and text.isprintable():
        return text.strip(" ")
    out = unicodedata.normalize("NFD", text.replace("\r\n", "\n")).translate(_TABLE)
    out = unicodedata.normalize("NFD", out)
    if "ı" in out:
        out = _dotted(out)
    return out.strip(" \n")


def _dotted(text: str) -> str:
    """A dotless i under a mark above it looks as i does there, which loses its dot too."""
    out = list(text)
    for i, ch in enumerate(out):
        if ch == "ı":
            j = i + 1
            while j < len(out) and 0 < unicodedata.combining(out[j]) < 230:
                j += 1
            if j < len(out) and unicodedata.combining(out[j]) == 230:
                out[i] = "i"
    return "".join(out)


@F.arrow_udf(T.StringType())
def _skeletons(texts: pa.Array) -> pa.Array:
    return pa.array([skeleton(t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def _forms(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string())


def skeleton_column(text: Column | str) -> Column:
    return _skeletons(F.col(text) if isinstance(text, str) else text)


def consistent_form(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(id, form) per row: the composed skeleton, equal for texts that look the same. Null texts stay null."""
    return df.select(F.col(id_col), _forms(skeleton_column(F.col(text_col).cast("string"))).alias("form"))


def variants(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Originals grouped by equal skeleton: (form, n_rows, n_variants, most_common), of those with two or more variants.

    Rows are first counted per distinct text, which takes any hot text down to one row per task; null texts are left out.
    """
    texts = df.select(F.col(text_col).cast("string").alias("t")).filter("t is not null").groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    grouped = texts.withColumn("form", _forms(skeleton_column("t"))).groupBy("form")
    found = grouped.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_variants"), F.max(F.struct("n", "t"))["t"].alias("most_common"))
    return found.filter("n_variants > 1")


def look_alikes(rows: DataFrame, fixed: DataFrame, row_id: str = "utt_id", fixed_id: str = "prompt_id", text_col: str = "text") -> DataFrame:
    """(row_id, fixed_id), each pair once: texts that look the same though their strings differ.

    Null texts and null ids match nothing, repeated rows count once, and texts of which nothing shows
    match nothing. Spark chooses the join by the size of ``fixed``: broadcast below its threshold, else a sort-merge
    join, whose hot skeletons AQE splits.
    """
    # AQE gets the choice: statistics of a Python column are those of its input.
    one = rows.select(F.col(row_id), F.col(text_col).cast("string").alias("t")).filter(f"`{row_id}` is not null and t is not null")
    two = fixed.select(F.col(fixed_id), F.col(text_col).cast("string").alias("u")).filter(f"`{fixed_id}` is not null and u is not null")
    one = one.withColumn("k", skeleton_column("t")).filter("k <> ''")
    two = two.withColumn("k", skeleton_column("u"))
    return one.join(two, "k").filter("t <> u").select(row_id, fixed_id).distinct()


# Fixed values, written by Latin letter and apart from the table above, against which SQL holds it: what has the shape of each letter.
_LOOK_ALIKES = """
A А Α Ꭺ ꓮ|B В Β Ᏼ ꓐ Ⲃ|C С Ϲ Ꮯ ꓚ Ⲥ|D Ꭰ ꓓ|E Е Ε Ꭼ ꓰ|F ꓝ|G Ԍ Ꮐ ꓖ|H Н Η Ꮋ ꓧ Ⲏ|I І Ӏ Ι ꓲ Ⲓ|J Ј Ϳ Ꭻ ꓙ|K К Κ Ꮶ ꓗ Ⲕ|L Լ Ꮮ ꓡ|M М Μ Ꮇ ꓟ Ⲙ|N Ν ꓠ Ⲛ
O О Ο Օ ꓳ Ⲟ|P Р Ρ Ꮲ ꓑ Ⲣ|Q Ԛ|R Ꭱ Ꮢ ꓣ|S Ѕ Տ Ꮪ ꓢ|T Т Τ Ꭲ ꓔ Ⲧ|U Ս ꓴ|V Ѵ Ꮩ ꓦ|W Ԝ Ꮃ Ꮤ ꓪ|X Х Χ ꓫ Ⲭ|Y У Υ Ү Ꭹ ꓬ Ⲩ|Z Ζ Ꮓ ꓜ Ⲍ
a а|b Ꮟ|c с ϲ ⲥ ᴄ|d ԁ Ꮷ|e е|g ց ɡ|h һ հ Һ|i і Ꭵ|j ј ϳ|l ӏ|n ո|o о ο օ ⲟ ᴏ|p р ρ ⲣ|q ԛ|s ѕ ꜱ|u ս|v ѵ ν ᴠ|w ԝ ᴡ|x х ⲭ|y у ү|z ᴢ
Ɖ Ð Đ|Ə Ә|ə ә ǝ|Ɵ Ө|ɵ ө|Ʒ Ӡ|ʒ ӡ|Æ Ӕ|æ ӕ|Ɛ Ԑ|ɛ ε ԑ|Ɔ Ͻ ꓛ Ↄ|ɔ ͻ ᴐ ↄ|Ʃ Σ|Ʌ Λ ꓥ|Ǝ ꓱ|ɑ α|ɩ ι|ʋ υ|ɣ γ|ƞ η|ɸ φ|ĸ к κ|ȷ յ|ɢ ԍ
"""


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def skeleton_sql(text: str) -> str:
    """The skeleton as DuckDB SQL, for texts of the Basic Multilingual Plane: composed instead of decomposed, which tells the same texts apart.

    It is worked out from other sources than ``_TABLE``: letters from the list by Latin letter, width from the distance of full-width forms,
    joined letters by name, and what does not show from the ranges of Unicode.
    """
    alike = {x: row[0] for row in _LOOK_ALIKES.replace("|", "\n").split("\n") if row for x in row[2:].split(" ")}
    alike |= {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    alike |= dict.fromkeys("\u2018\u2019\u201b\u02bc\u02bb\u02bd\u02c8\u02b9\u2032\uff07\ua78c\u055a", "'")
    alike |= dict.fromkeys("\t\v\f\x1c\x1d\x1e\x1f\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000", " ")
    alike |= dict.fromkeys("\r\x85\u2028\u2029", "\n")
    alike |= {chr(0x2160 + i): x for i, x in zip((0, 4, 9), "IVX")} | {chr(0x2170 + i): x for i, x in zip((0, 4, 9), "ivx")}
    alike |= {chr(base + 12 + i): x for base, letters in ((0x2160, "LCDM"), (0x2170, "lcdm")) for i, x in enumerate(letters)}
    joined = {"\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl", "\ufb03": "ffi", "\ufb04": "ffl", "\ufb06": "st", "\ufb05": "\u017ft", "\u01c7": "LJ", "\u01c8": "Lj", "\u01c9": "lj", "\u01ca": "NJ", "\u01cb": "Nj", "\u01cc": "nj", "\u01f1": "DZ", "\u01f2": "Dz", "\u01f3": "dz", "\u0132": "IJ", "\u0133": "ij", "\u01c4": "D\u017d", "\u01c5": "D\u017e", "\u01c6": "d\u017e"}
    out = f"replace(nfc_normalize({text}), chr(13) || chr(10), chr(10))"
    for ch, letters in joined.items():
        out = f"replace({out}, {_sql_text(ch)}, {_sql_text(letters)})"
    # a composed letter of another alphabet changes with its base: decomposed by hand where the base has a Latin shape
    for code in [*range(0x370, 0x530), *range(0x1F00, 0x2000)]:
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0] in alike:
            out = f"replace({out}, {_sql_text(chr(code))}, {_sql_text(parts)})"
    out = f"translate({out}, {_sql_text(''.join(alike))}, {_sql_text(''.join(alike.values()))})"
    gone = "\\x{ad}\\x{34f}\\x{600}-\\x{605}\\x{61c}\\x{6dd}\\x{70f}\\x{890}-\\x{891}\\x{8e2}\\x{115f}-\\x{1160}\\x{17b4}-\\x{17b5}\\x{180b}-\\x{180f}\\x{200b}-\\x{200f}\\x{202a}-\\x{202e}\\x{2060}-\\x{2064}\\x{2066}-\\x{206f}\\x{3164}\\x{fe00}-\\x{fe0f}\\x{feff}\\x{ffa0}\\x{fff9}-\\x{fffb}\\x{e0100}-\\x{e01ef}"
    out = f"nfc_normalize(regexp_replace({out}, '[{gone}]', '', 'g'))"
    for mark in "\u0300\u0301\u0302\u0303\u0304\u030c\u0307":
        out = f"replace({out}, 'ı{mark}', '{unicodedata.normalize('NFC', 'i' + mark)}')"
    return f"regexp_replace(nfc_normalize({out}), '^[ \\n]+|[ \\n]+$', '', 'g')"
