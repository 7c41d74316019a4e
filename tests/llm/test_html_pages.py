"""Pages that the tables don't have: other languages, wrappers, links inside articles."""

import pytest
from pyspark.sql import functions as F

from docloom.llm.html import extract_main_text, main_text

PROSE = {
    "pl": "Wczoraj wieczorem mieszkańcy miasteczka zebrali się na rynku, żeby obejrzeć pokaz świateł, który przygotowali uczniowie szkoły. Burmistrz podziękował wszystkim, a orkiestra zagrała kilka znanych melodii. Deszcz nikomu nie przeszkadzał.",
    "it": "Ieri sera gli abitanti del paese si sono riuniti nella piazza, perché volevano vedere le luci preparate dagli studenti. Il sindaco ringraziò tutti quanti, mentre la banda suonava alcune melodie. La pioggia disturbò pochi.",
    "zh": "昨天晚上，小镇的居民聚集在广场上，观看学生们准备的灯光表演。市长向大家表示感谢，乐队演奏了几首著名的曲子。雨没有打扰任何人，孩子们一直玩到深夜才回家。",
    "ru": "Вчера вечером жители городка собрались на площади, чтобы посмотреть представление, которое подготовили ученики школы. Мэр поблагодарил всех, а оркестр сыграл несколько известных мелодий. Дождь никому не мешал.",
    "tr": "Dün akşam kasaba halkı, okul öğrencilerinin hazırladığı ışık gösterisini izlemek için meydanda toplandı. Belediye başkanı herkese teşekkür etti, orkestra ise birkaç tanınmış ezgi çaldı. Yağmur kimseyi rahatsız etmedi.",
    "fi": "Eilen illalla kylän asukkaat kokoontuivat torille katsomaan valoesitystä, jonka koulun oppilaat olivat valmistelleet. Pormestari kiitti kaikkia, ja orkesteri soitti muutaman tutun sävelmän. Sade ei haitannut ketään.",
    "ar": "اجتمع سكان البلدة مساء أمس في الساحة، لمشاهدة عرض الأضواء الذي أعده تلاميذ المدرسة. شكر رئيس البلدية الجميع، وعزفت الفرقة بعض الألحان المعروفة. لم يزعج المطر أحدا، وبقي الأطفال يلعبون حتى وقت متأخر من الليل.",
    "en": "Last night the people of the town met on the square to see the lights that the pupils of the school had made. The mayor thanked all of them, and the band played some tunes that everyone knew. The rain was no trouble to anyone.",
}
MENU = '<ul><li><a href="/">Home</a></li><li><a href="/a">News</a></li><li><a href="/b">Contact us</a></li></ul>'


@pytest.mark.parametrize("lang", sorted(PROSE))
@pytest.mark.parametrize("frame", ["{}", "<form action=/x>{}<input name=q></form>", "<article>{}</article>", '<div class="social"><article>{}</article></div>'])
def test_prose_in_any_language(lang, frame):
    text = PROSE[lang]
    page = f"<body>{MENU}{frame.format(f'<p>{text}</p><p>{text}!</p><p>{text}</p>')}<footer>© 2024 us</footer></body>"
    assert main_text(page).split("\n") == [text, text + "!", text]


@pytest.mark.parametrize("lang", ["pl", "zh", "en"])
def test_what_is_not_prose_stays_out(lang):
    page = f"<body><div>Home | News | About</div><form>Your name <input> <button>Send</button></form><p>{PROSE[lang]}</p><p>{PROSE[lang]}</p><div>Copyright 2024 Firm Ltd all</div></body>"
    assert main_text(page).split("\n") == [PROSE[lang]] * 2


def test_links_inside_an_article():
    en = PROSE["en"]
    body = f'<h2><a href="/x">A headline that is a link</a></h2><p>{en}</p><p>See <a href="/1">the first report on this matter</a> and <a href="/2">the second one of last year</a>, too.</p><p class="search">{en}</p>'
    assert main_text(f"<article>{body}</article>").split("\n") == ["A headline that is a link", en, "See the first report on this matter and the second one of last year, too.", en]
    # A list of links isn't a sentence, and readers' words stay out though they are articles.
    more = f'<article><p>{en}</p><p><a href="/1">One more of the stories here</a> <a href="/2">Another of the stories here</a></p></article><div id="comments"><article><p>{en} I think.</p></article></div>'
    assert main_text(more) == en
    assert main_text(f'<div id="comments"><article><p>{en} I think.</p></article></div>') == ""
    assert main_text(f'<article><p>{en}</p><div class="social"><p>{en}</p></div></article>') == en


def test_tables_of_odd_pages(spark):
    schema = "page_id long, url string, html string"
    rows = [(1, "u", f"<p>{PROSE['en']}"), (1, None, None), (None, "v", ""), (2, "w", "<" * 1000), (3, "x", "<article>" + "<p>a</p>" * 20_000)]
    pages = spark.createDataFrame(rows, schema).withColumns({"text": F.lit("other"), "n_chars": F.lit(1)})
    got = sorted(((r.page_id or 0, r.n_chars) for r in extract_main_text(pages).collect()))
    assert [n for _, n in got] == [0, 0, len(PROSE["en"]), 1000, 39_999] or [n for _, n in got][-1] == 39_999
    assert extract_main_text(pages.limit(0)).count() == 0 and extract_main_text(pages).columns == ["page_id", "url", "text", "n_chars"]
