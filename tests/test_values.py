import pytest

from sheetloom.functions import clean as c
from sheetloom.functions import titles


@pytest.mark.parametrize("text,number", [
    ("₹ 780", 780.0), ("Rs. 500", 500.0), ("1,234.50/-", 1234.5), ("5%", 5.0), ("-50", -50.0),
    ("N/A", None), ("", None), (" nan ", None), (None, None), ("1.2.3", None)])
def test_clean_float(one, text, number):
    assert one(c.clean_float, text) == number


@pytest.mark.parametrize("text,number", [("2 Pcs", 2), ("2.9", 2), ("-2.9", -2), ("99999999999", None), ("x", None)])
def test_clean_int(one, text, number):
    assert one(c.clean_int, text) == number


@pytest.mark.parametrize("text,count", [
    ("₹8490 (6 Pcs)", 6), ("8 Designs", 8), ("1 Pc", 1), ("Pack of 4", 4), ("set of 6", 6), ("12", 12), ("many", None)])
def test_declared_count(one, text, count):
    assert one(c.declared_count, text) == count


def test_header_key_and_token(one):
    assert one(c.header_key, " Work/Print - Type. ") == "work_print_type"
    assert one(c.clean_token, " AMRAH  Kriti_Vol.58 ") == "amra-kriti-vol-58"
    assert one(c.clean_token, "Fabriqué Ë") == "fabriqué-ë"
    assert one(c.title_case, "ab-CD e3f") == "Ab-Cd E3F"


def test_natural_key_order(one):
    names = ["img10.jpg", "img1.jpg", "img2.jpg", "img20.jpg", "img3.jpg", "(a).jpg", "7.jpg", "img002b.jpg"]
    ordered = sorted(names, key=lambda n: one(c.natural_key, n))
    assert ordered == ["7.jpg", "(a).jpg", "img1.jpg", "img2.jpg", "img002b.jpg", "img3.jpg", "img10.jpg", "img20.jpg"]


@pytest.mark.parametrize("name,group", [
    ("Rajtex Ajrak Vol-58", "Rajtex-A"), ("Mahotsav Kriti", "Mahots-K"), ("BUNAWAT ERADI 142001 TO 142005 Series", "BUNAWA-E"),
    ("SETHNIC LIFESTYLE SAREE", "SETHNI-LS"), ("Single", "Single"), ("", "GROUP-1"), (None, "GROUP-1")])
def test_product_group(one, name, group):
    assert one(titles.product_group, name) == group


@pytest.mark.parametrize("name,sku", [("Rajtex Ajrak Vol-58", "Vol-58"), ("Noor volume 12 b", "Vol-12"),
                                      ("BUNAWAT ERADI Series 142000", "142000"), (None, None)])
def test_fallback_sku(one, name, sku):
    assert one(titles.fallback_sku, name) == sku


def test_title(one):
    assert one(titles.product_title, "Rajtex Ajrak Vol-58", "Rajtex", "Modal Satin", "Ajrakh Print", "Saree") == \
        "Rajtex Ajrakh Printed Modal Satin Saree"
    assert one(titles.product_title, "BUNAWAT ERADI", "BUNAWAT", "Silk", None, "Saree") == "BUNAWAT ERADI Silk Saree"


def test_description(one):
    text = one(titles.product_description, None, "Rajtex", "Noor", "Silk", "Silk", "Zari", None, "Saree", 1415.0)
    assert text == ("Discover this elegant Silk Saree from Rajtex (Noor Collection). Showcases exquisite Zari. "
                    "Includes a matching coordinated blouse piece. Single piece dropshipping price: ₹1,415.")


def test_absurd_numbers_do_not_stop_a_job(one):
    assert one(lambda x: c.amount_text(x.cast("double")), "123456789012345678901234").endswith(".00")
    assert one(lambda x: c.amount_text(x.cast("double")), "1e300") is None
    assert one(lambda x: c.clean_int(x), "123456789012345678901234") is None


def test_absurd_prices_in_texts(spark):
    from sheetloom.operators import facts

    text = "Rate: 123456789012345678901234\nWholesale - 123456789012345678901234567\nBrand - X"
    documents = spark.createDataFrame([("r", 1, "a", "SUCCESS", "p", text, 0.9)], "run_id string, doc_id bigint, filename string, status string, provider string, "
                                      "text string, confidence double")
    found = facts.all_facts(documents)
    assert {r.field for r in found.collect()} >= {"brand", "price", "wholesale_price"}
    assert facts.reconciled_prices(documents).first().wholesale_price > 1e26
