
import io
import zipfile

from lodestone.functions import splitter
from lodestone.functions.splitter import by_sentence, clean, split, summary, tokens
from lodestone.operators.documents import chunks
from lodestone.plans import samples
from lodestone.sources.parsers import parse


def words(n_tokens, end=""):
    """A text of so many tokens."""
    return ("abc " * n_tokens)[: 4 * n_tokens - 1 - len(end)] + "x" + end


def cut(data, kind):
    blocks, meta = parse(data, kind)
    return chunks(blocks, "d", kind, "/d", meta)


def slides(*shapes, notes=""):
    ns = 'xmlns:p="p" xmlns:a="a"'
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        for k, x in enumerate(shapes, 1):
            f.writestr(f"ppt/slides/slide{k}.xml", f"<p:sld {ns}><p:cSld><p:spTree>{x}</p:spTree></p:cSld></p:sld>")
        if notes:
            f.writestr("ppt/notesSlides/notesSlide1.xml", f"<p:notes {ns}><p:cSld><p:spTree>{shape(notes, 'body')}</p:spTree></p:cSld></p:notes>")
    return z.getvalue()


def shape(text, kind=""):
    return f"<p:sp><p:nvSpPr><p:nvPr>{f'<p:ph type={chr(34)}{kind}{chr(34)}/>' if kind else ''}</p:nvPr></p:nvSpPr><p:txBody><a:p>{text if '<' in text else f'<a:r><a:t>{text}</a:t></a:r>'}</a:p></p:txBody></p:sp>"


def test_q1_a_long_paragraph_after_a_full_piece_stays_whole():
    long = ". ".join(words(150) for _ in range(5)) + "."
    assert split(words(250) + "\n\n" + long) == [words(250), long]
    after_little = split(words(20) + "\n\n" + long)
    assert after_little[0] == words(20) and len(after_little) > 2
    assert len(split(words(150) + "\n\n" + words(450) + "\n\n" + words(10))) == 2  # too little for a piece of its own grows past the limit
    assert [tokens(x) > 500 for x in by_sentence(words(190, ".") + " " + words(400, "."))] == [True]


def test_q2_tokens_of_parts_are_rounded_one_by_one():
    assert tokens("abcde") == 2 and tokens("") == 0
    # 250 and 251 tokens are more than 500, though the two with their blank line are 2,000 characters
    a, b = "x" * 997, "y" * 1001
    assert tokens(f"{a}\n\n{b}") == 500 and split(f"{a}\n\n{b}\n\nz") == [a, f"{b}\n\nz"]
    # 250 and 250 are not
    assert split(f"{a}\n\n{a}\n\n{'z' * 40}") == [f"{a}\n\n{a}", "z" * 40]


def test_q3_sections_of_up_to_a_thousand_tokens_stay_single():
    for n, many in ((501, False), (1000, False), (1001, True)):
        text = words(n // 2) + "\n\n" + words(n - n // 2)
        text = text[2:]  # the blank line counts
        assert tokens(text) == n
        assert (len(cut(text.encode(), "txt")) > 1) == many


def test_q4_white_space_after_sentences_becomes_a_blank():
    assert by_sentence("One.\n\nTwo!  Three?\tFour", 500, 200) == ["One. Two! Three? Four"]


def test_q5_sections_are_cleaned_whole():
    assert [c["full_text"] for c in cut(b"```\nif x:\n        y   =  1\n```", "md")] == ["if x:\n y = 1"]
    assert clean("a\t\t b\n\n\n\nc") == "a b\n\nc"


def test_q6_a_summary_may_end_at_the_number_of_a_list():
    assert summary("The parts:\n\n1. first\n2. second") == "The parts:\n\n1."


def test_q7_metadata_of_headings_is_lost():
    got = cut(slides(shape("Only a title", "title"), shape("Second", "title") + shape("text"), notes="said of the first"), "pptx")
    assert [("speakerNotes" in c["metadata"]) for c in got] == [False]
    got = cut(slides(shape("Title", "title") + shape("text"), notes="said of it"), "pptx")
    assert got[0]["metadata"]["speakerNotes"] == "said of it"


def block(kind="paragraph", content="Text.", **more):
    return {"type": kind, "content": content} | more


def test_q8_the_page_is_that_of_the_last_block():
    got = chunks([block("heading", "H", level=1, page_number=1), block(page_number=1), block(page_number=3)], "d", "pdf", "/d", {})
    assert [c["page_number"] for c in got] == [3]


def test_q9_regions_of_a_sheet_are_one_chunk():
    sheet = [block("heading", "S", level=1, sheet_name="S"), *(block("table", f"t{k}", is_table=True, sheet_name="S") for k in range(3))]
    got = chunks(sheet, "d", "xlsx", "/d", {})
    assert [(c["full_text"], c["is_table"]) for c in got] == [("S\n\nt0\n\nt1\n\nt2", True)]


def test_q10_flags_of_a_mail_land_on_its_chunk():
    got = cut(b"Subject: S\nFrom: a@b.c\n\nHello.\n\n> quoted\n\nRegards,\nA\n", "eml")
    assert len(got) == 1 and got[0]["metadata"]["isQuotedReply"] and got[0]["metadata"]["isSignature"]


def test_q11_to_q13_word_files():
    assert not any(b.get("is_code") for b in parse(samples.word(samples.word_paragraph("x = 1", "HTMLPreformatted")), "docx")[0])  # Q11
    nested = samples.word(samples.word_paragraph("a", num="01") + samples.word_paragraph("b", num="11") + samples.word_paragraph("c", num="01"))
    assert [(b["type"], b["content"]) for b in parse(nested, "docx")[0]] == [("list", "- b"), ("paragraph", "c")]  # Q12
    table = parse(samples.word(samples.word_table([["k", "v"], ["a", "b"]])), "docx")[0]
    assert [b["type"] for b in table] == ["table"] and table[0]["content"].split("\n")[2].split(" | ")[0].strip() == "a"  # Q13


def test_q14_headers_of_pages_go_and_line_breaks_are_nothing():
    got = cut(b"<body><header><h1>Gone</h1></header><p>one<br>two</p></body>", "html")
    assert [(c["heading_path"], c["full_text"]) for c in got] == [([], "onetwo")]


def test_q15_a_rule_under_a_blank_line_is_an_empty_heading():
    got = cut(b"Intro text.\n\n---\nText below.", "txt")
    assert got[-1]["heading_path"][-1:] == [""] and got[-1]["section_title"] == "" and got[-1]["title_text"] == ""


def test_q16_groups_fields_and_breaks_of_slides_are_passed_over():
    got = parse(slides(shape("T", "title") + f"<p:grpSp>{shape('in a group')}</p:grpSp>" + shape("<a:r><a:t>one</a:t></a:r><a:br/><a:fld><a:t>field</a:t></a:fld><a:r><a:t>two</a:t></a:r>")), "pptx")[0]
    assert [b["content"] for b in got] == ["T", "onetwo"]


def test_q17_merged_cells_are_as_they_are_stored():
    from lodestone.sources.parsers.office import regions

    assert regions([["wide", "", ""], ["a", "b", "c"]]) == [[["wide", "", ""], ["a", "b", "c"]]]


def test_q19_lengths_are_of_utf_16_and_space_is_unicode():
    assert splitter.units("a\U0001f600") == 3 and tokens("\U0001f600" * 2) == 1 and tokens("\U0001f600" * 3) == 2
    assert splitter.trim("\u00a0\ufeff x \u2028\u3000") == "x"
