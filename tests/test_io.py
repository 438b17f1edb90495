import os
import tempfile

from pyspark.sql import functions as F

from fixtures import REVIEWS
from tabmine.sources.io import read_reviews_csv


def test_csv_reader_fixed_schema_and_null_tokens(spark):
    d = tempfile.mkdtemp(prefix="tabmine-csv-")
    p = os.path.join(d, "reviews.csv")
    header = ",country,description,designation,points,price,province,region_1,region_2,taster_name," \
             "taster_twitter_handle,title,variety,winery"

    def q(v):
        return '"' + str(v).replace('"', '""') + '"' if v is not None else "NA"
    with open(p, "w") as f:
        f.write(header + "\n")
        for r in REVIEWS:
            rid, country, desc, des, pts, price, prov, reg1, taster, title, variety = r
            f.write(",".join([str(rid), q(country), q(desc), q(des), str(pts), "nan" if price is None else str(price),
                              q(prov), q(reg1), "", q(taster), "", q(title), q(variety), q("W")]) + "\n")
    df = read_reviews_csv(spark, p)
    assert df.count() == 12
    r1 = df.where(F.col("row_id") == 1).first()
    assert r1["description"] == "This is ripe\nand fruity."      # quoted multi-line text
    r0 = df.where(F.col("row_id") == 0).first()
    assert r0["price"] is None and df.where(F.col("country").isNull()).count() == 1
    assert df.agg(F.max("price")).first()[0] == 3300.0          # NaN token is null, not NaN
