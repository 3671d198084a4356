"""Segments of marked text: the units inside which pieces are formed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.text import USER_SYMBOLS, WORD_MARK, is_non_empty, marked

#: scripts that a piece may not mix: those of Unicode 13, which both regular-expression dialects know
SCRIPTS = """
Adlam Ahom Anatolian_Hieroglyphs Arabic Armenian Avestan Balinese Bamum Bassa_Vah Batak Bengali Bhaiksuki Bopomofo
Brahmi Braille Buginese Buhid Canadian_Aboriginal Carian Caucasian_Albanian Chakma Cham Cherokee Chorasmian Coptic
Cuneiform Cypriot Cyrillic Deseret Devanagari Dives_Akuru Dogra Duployan Egyptian_Hieroglyphs Elbasan Elymaic Ethiopic
Georgian Glagolitic Gothic Grantha Greek Gujarati Gunjala_Gondi Gurmukhi Hangul Hanifi_Rohingya Hanunoo Hatran Hebrew
Imperial_Aramaic Inscriptional_Pahlavi Inscriptional_Parthian Javanese Kaithi Kannada Kayah_Li Kharoshthi
Khitan_Small_Script Khmer Khojki Khudawadi Lao Latin Lepcha Limbu Linear_A Linear_B Lisu Lycian Lydian Mahajani Makasar
Malayalam Mandaic Manichaean Marchen Masaram_Gondi Medefaidrin Meetei_Mayek Mende_Kikakui Meroitic_Cursive
Meroitic_Hieroglyphs Miao Modi Mongolian Mro Multani Myanmar Nabataean Nandinagari New_Tai_Lue Newa Nko Nushu
Nyiakeng_Puachue_Hmong Ogham Ol_Chiki Old_Hungarian Old_Italic Old_North_Arabian Old_Permic Old_Persian Old_Sogdian
Old_South_Arabian Old_Turkic Oriya Osage Osmanya Pahawh_Hmong Palmyrene Pau_Cin_Hau Phags_Pa Phoenician
Psalter_Pahlavi Rejang Runic Samaritan Saurashtra Sharada Shavian Siddham SignWriting Sinhala Sogdian Sora_Sompeng
Soyombo Sundanese Syloti_Nagri Syriac Tagalog Tagbanwa Tai_Le Tai_Tham Tai_Viet Takri Tamil Tangut Telugu Thaana Thai
Tibetan Tifinagh Tirhuta Ugaritic Vai Wancho Warang_Citi Yezidi Yi Zanabazar_Square
""".split()
#: one writing system, kept together
MERGED_SCRIPTS = ("Han", "Hiragana", "Katakana")


def _script(name: str, dialect: str) -> str:
    return rf"\p{{Is{name}}}" if dialect == "java" else rf"\p{{{name}}}"


def training_pattern(dialect: str = "java") -> str:
    """Pattern of one segment in marked text, for Java or RE2.

    A digit on its own, word marks followed by a run of one script, or word
    marks alone.  What has no script of its own (punctuation, symbols, marks that
    stand alone) is a run too; marks that follow a letter belong to its run.
    Newlines stand where a user symbol was and match nothing.
    """
    inherited = _script("Inherited", dialect)
    # the first alternatives are the fastest
    names = sorted(SCRIPTS, key=lambda name: name != "Latin")
    singles = [_script(name, dialect) for name in names]
    merged = "".join(_script(name, dialect) for name in MERGED_SCRIPTS) + "ー"
    runs = [rf"[{name}{inherited}]+" for name in (*singles, merged)]
    rest = rf"[^{WORD_MARK}0-9\n{''.join(singles)}{merged}]+"
    return rf"[0-9]|{WORD_MARK}*(?:{'|'.join([*runs, rest])})|{WORD_MARK}+"


def symbol_pattern() -> str:
    return "|".join(symbol.replace("|", r"\|") for symbol in USER_SYMBOLS)


def training_lines(text: Column) -> Column:
    """Lines of a text that the trainer reads: not empty."""
    return F.filter(F.split(text, "\n"), lambda line: is_non_empty(line))


def line_chunks(line: Column) -> Column:
    """One line with word marks added, cut before each run of them: no segment or user symbol crosses a cut."""
    return F.split(marked(line), f"(?<=[^{WORD_MARK}])(?={WORD_MARK})")


def chunk_segments(chunk: Column) -> Column:
    """Segments of one of :func:`line_chunks`; no segment crosses a user symbol."""
    parted = F.regexp_replace(chunk, symbol_pattern(), "\n")
    return F.regexp_extract_all(parted, F.lit(training_pattern()), F.lit(0))
