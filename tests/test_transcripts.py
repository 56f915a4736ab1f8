"""Transcripts to sentence records with the Hebrew preset, and unique ids."""

from corpuslab.functions.presets import HEBREW, LATIN
from corpuslab.operators import sentences as SN
from corpuslab.operators import transcripts as TR

PARAS = "file_id string, protocol_name string, para_idx long, text string"


def _paras(spark, files):
    rows = [(name, name, i, t) for name, texts in files.items() for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, PARAS)


def _numbers(spark, files, preset):
    t = TR.file_texts(_paras(spark, files))
    return {r["file_id"]: r["n"] for r in t.select("file_id", SN.protocol_number("text", preset).alias("n")).collect()}


def test_protocol_number_of_the_joined_text(spark):
    word, n = next(iter(HEBREW.ordinals.items()))
    files = {
        "a": ["כותרת", f"הישיבה {word} של הכנסת", "פרוטוקול מס' 45, 46"],  # digits win, though they come later
        "b": ["הישיבה", f"{word.replace(' ', '-')} של", "הכנסת"],          # over three paragraphs, with a hyphen
        "c": ["פרוטוקול מס'", "17"],
        "d": ["הישיבה הלא ידועה של הכנסת"],
        "e": ["שום דבר"]}
    assert _numbers(spark, files, HEBREW) == {"a": 45, "b": n, "c": 17, "d": -1, "e": -1}


def test_hebrew_transcript_to_sentences(spark):
    marked = HEBREW.marked_files[0]
    files = {
        "25_ptm_100.docx": ["פרוטוקול מס' 7", "דברי פתיחה שאינם של איש כאן.", "דוד לוי:", "אנחנו פותחים היום את הדיון הזה. קצר מאוד.", "נמשיך מחר בבוקר בשעה עשר!",
                            "יו\"ר משה כהן (סיעה):", "תודה רבה לכל חברי הוועדה כאן -- היום.", "זה משפט נוסף של היושב ראש עכשיו."],
        marked: ["<< דובר >> רות ישראלי:", "זהו משפט ראשון של הדוברת בקובץ הזה."]}
    rows = TR.sentence_records(_paras(spark, files), HEBREW).orderBy("file_id", "turn_id", "piece_pos").collect()
    one = [r for r in rows if r["file_id"] == "25_ptm_100.docx"]
    assert {(r["knesset_number"], r["protocol_type"], r["protocol_number"]) for r in one} == {(25, "plenary", 7)}
    assert [r["speaker_name"] for r in one][0] == "דוד לוי" and len({r["speaker_name"] for r in one}) == 2
    assert [r["sentence_text"] for r in one][:2] == ["אנחנו פותחים היום את הדיון הזה .", "נמשיך מחר בבוקר בשעה עשר !"]
    assert not any("--" in r["sentence_text"] for r in rows)
    assert len({r["sent_id"] for r in rows}) == len(rows)
    assert [r["speaker_name"] for r in rows if r["file_id"] == marked] != []


def test_sentence_ids_never_meet(spark):
    """A file of 150 turns, a turn of 12,000 pieces, and files whose packed numbers would be equal."""
    many = [(1, t, "this is one of the sentences here. and so is this one then.") for t in range(150)] + [(2, 0, "this is another sentence for you.")]
    long = [(3, 0, "this piece has five words. " * 12_000), (3, 1, "and the next turn begins here.")]
    turns = spark.createDataFrame(many + long, "file_id long, turn_id long, text string")
    s = SN.sentences_from_turns(turns, LATIN)
    n, distinct = s.count(), s.select("sent_id").distinct().count()
    assert n == distinct == 150 * 2 + 1 + 12_000 + 1
