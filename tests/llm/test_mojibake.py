import pytest

from vigilake.llm import mojibake as M

SIGNALS = "row_id long, title string, summary string"
CLEAN = ["Müller prüft das Gerät für Höhe", "Vélvaro’s pump – “alarm broker” 45 °C ± 2 °C", "Élypova QA-8594™ and Brønnexa® café", "NÃO CONECTE à rede", "ポンプの管理画面に関する注意喚起です。", "µg/l above 47 kΩ – über", "¿Usa incubadora? Actualización disponible", "naïve façade – señor"]


@pytest.fixture(scope="module")
def model(spark):
    rows = spark.createDataFrame([(i, c, None) for i, c in enumerate(CLEAN * 40)], SIGNALS)
    return M.Model(M.model(rows))


@pytest.mark.parametrize("text", ["Gerät für Vélvaro", "“alarm broker” – 45 °C", "Brønnexa QA-1®"])
@pytest.mark.parametrize(("inside", "outside"), [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "mac_roman"), ("utf-8", "cp1251"), ("cp1252", "cp437")])
def test_round_trip(model, text, inside, outside):
    wrong = M.garble(text, inside, outside)
    state, restored = model.label(wrong)
    assert restored == text, (state, wrong)


@pytest.mark.parametrize("text", [*CLEAN, "plain", "", "+AUX- adapter and X+Set-B", "caf&eacute; für", "What is it? See /status?unit=1"])
def test_clean_texts_are_left_alone(model, text):
    assert model.label(text) is None


@pytest.mark.parametrize(("text", "state", "restored"), [
    ("Br�nnexa", "lost", None), ("K??rwick hub", "lost", None), ("Pr+APw-fung", "utf7", "Prüfung"), (M.garble("ポンプの管理画面に関する注意喚起です。", "cp932", "cp1252"), "sjis", "ポンプの管理画面に関する注意喚起です。"),
    ("Gerã¤t fã¼r", "utf8>cp1252 in lower case", "Gerät für"), ("Br�nnexa: " + M.garble("Gerät für", "utf-8", "cp1252"), "utf8>cp1252", "Br�nnexa: Gerät für"), ("Pr+APw-fung Br�nnexa", "utf7", "Prüfung Br�nnexa"), ("Ger&Atilde;&curren;t", "utf8>cp1252", "Gerät"),
])
def test_other_forms(model, text, state, restored):
    got = model.label(text)
    assert got is not None and got[1] == restored and got[0].split(" ")[0] == state.split(" ")[0]


def test_rows_nulls_and_repeats(spark):
    wrong = M.garble("Gerät für Vélvaro", "utf-8", "cp1252")
    rows = spark.createDataFrame([(1, wrong, None), (1, wrong, None), (2, None, ""), (3, CLEAN[0], wrong), *[(9, c, None) for c in CLEAN * 30]], SIGNALS).selectExpr("*", "1 as field", "2 as v")
    assert sorted(map(tuple, M.found(rows).collect())) == [(1, "title"), (1, "title"), (3, "summary")]
    assert M.found(rows.limit(0)).count() == 0


def test_very_long_text(model):
    assert model.label("für " * 20_000) is None
    assert model.label(M.garble("für ", "utf-8", "cp1252") * 5_000)[1] == "für " * 5_000
