import gzip

from canopy.operators.prepare import prepare_reviews
from canopy.sources.reviews import REVIEW_COLUMNS, read_review_lines, read_reviews

HEADER = "\t".join(REVIEW_COLUMNS)


def line(**kw):
    base = {c: "" for c in REVIEW_COLUMNS}
    base.update(
        marketplace="US", customer_id="1", review_id="R1", product_id="P", product_parent="2",
        product_title="t", product_category="Books", star_rating="5", helpful_votes="3", total_votes="4",
        vine="N", verified_purchase="Y", review_headline="h", review_body="good", review_date="2015-08-31",
    )
    base.update(kw)
    return "\t".join(base[c] for c in REVIEW_COLUMNS)


def test_header_per_file_quotes_gz_short_lines(spark, tmp_path):
    d = tmp_path / "reviews"
    d.mkdir()
    (d / "a.tsv").write_text("\n".join([HEADER, line(review_id="R1"), line(review_id="R2", review_body='He said "hi\tthere')]) + "\n")
    with gzip.open(d / "b.tsv.gz", "wt") as f:
        f.write("\n".join([HEADER, line(review_id="R3", product_category="Toys'n games"), "US\t5\tR4"]) + "\n")
    df = read_reviews(spark, str(d), columns=None)
    rows = {r.review_id: r for r in df.collect()}
    # both headers skipped, 4 records, no merged fields from the stray quote
    assert set(rows) == {"R1", "R2", "R3", "R4"}
    assert rows["R2"].review_body == 'He said "hi'
    assert rows["R2"].review_headline == "h"
    assert rows["R3"].product_category == "Toys'n games"
    # short line: missing trailing fields are null, nothing raises
    assert rows["R4"].star_rating is None and rows["R4"].marketplace == "US"
    assert read_review_lines(spark, str(d)).count() == 6


def test_prepare_reviews(spark, tmp_path):
    p = tmp_path / "r.tsv"
    p.write_text(
        "\n".join(
            [
                HEADER,
                line(review_id="A", helpful_votes="3", total_votes="4", review_body="abc"),
                line(review_id="B", helpful_votes="1", total_votes="2", star_rating="2"),
                line(review_id="C", helpful_votes="1", total_votes="0", marketplace="", star_rating="x"),
            ]
        )
        + "\n"
    )
    raw = read_reviews(spark, str(p), columns=None)
    out = {r.review_id: r for r in prepare_reviews(raw, keep=("review_id",)).collect()}
    assert out["A"].is_vote_helpful is True and out["A"].body_len == 3.0 and out["A"].star_rating == "good"
    assert out["B"].is_vote_helpful is False and out["B"].star_rating == "good"
    assert out["C"].is_vote_helpful is False and out["C"].star_rating == "bad"
    # empty field is read as null and filled with the text 'false'
    assert out["C"].marketplace == "false"


def test_end_to_end_on_review_files(spark, tmp_path):
    """The original workflow: review TSV → prepare → split → bins → tree → score → store."""
    import random

    from canopy.__main__ import run
    from canopy.sources.trees import load_tree

    rnd = random.Random(5)
    lines = [HEADER]
    for i in range(400):
        vine = rnd.choice("YN")
        helpful = rnd.randint(0, 5)
        total = helpful + (rnd.randint(0, 2) if vine == "Y" else rnd.randint(0, 8))
        lines.append(
            line(
                review_id=f"R{i}",
                marketplace=rnd.choice(["US", "UK", "DE"]),
                product_category=rnd.choice(["Books", "Toys", "Music"]),
                vine=vine,
                verified_purchase=rnd.choice("YN"),
                star_rating=str(rnd.randint(1, 5)),
                helpful_votes=str(helpful),
                total_votes=str(total),
                review_body="x" * rnd.randint(0, 300),
            )
        )
    d = tmp_path / "in"
    d.mkdir()
    (d / "part1.tsv").write_text("\n".join(lines[:200]) + "\n")
    (d / "part2.tsv").write_text("\n".join([HEADER] + lines[200:]) + "\n")
    tree, score = run(spark, [str(d)], str(tmp_path / "tree"), show=0)
    assert score["n_rows"] > 0 and 0.0 <= score["mse"] <= 1.0
    leaves = tree.where("split_attr IS NULL")
    train_rows = leaves.agg({"pos": "sum", "neg": "sum"}).first()
    assert sum(train_rows) + score["n_rows"] == 400
    stored = load_tree(spark, str(tmp_path / "tree"))
    assert stored.count() == tree.count()


def test_columns_are_found_by_name(spark, tmp_path):
    import pytest

    swapped = list(REVIEW_COLUMNS)
    a, b = swapped.index("helpful_votes"), swapped.index("total_votes")
    swapped[a], swapped[b] = swapped[b], swapped[a]
    values = dict.fromkeys(swapped, "x") | {"helpful_votes": "9", "total_votes": "10"}
    one = tmp_path / "one.tsv"
    one.write_text("\t".join(swapped) + "\n" + "\t".join(values[c] for c in swapped) + "\n")
    row = read_reviews(spark, str(one)).first()
    assert (row.helpful_votes, row.total_votes) == ("9", "10")
    # files of different headers read together are refused, not mixed up
    two = tmp_path / "two.tsv"
    two.write_text(HEADER + "\n" + line() + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_reviews(spark, [str(one), str(two)]).collect()
    short = tmp_path / "short.tsv"
    short.write_text("marketplace\tvine\nUS\tN\n")
    with pytest.raises(ValueError, match="star_rating"):
        read_reviews(spark, str(short))
    assert read_reviews(spark, str(short), columns=("vine",)).first().vine == "N"
