"""Hand-made micro fixtures (invented names) with edge cases."""

from pyspark.sql import types as T

from tabmine.sources.io import REVIEW_SCHEMA

NBSP = " "

# row_id, country, description, designation, points, price, province, region_1, taster_name, title, variety
REVIEWS = [
    (0, "Italy", "Aromas include  tropical fruit.", "Vulka", 87, None, "Sicily", "Etna", "T1", "W0 2013 Bianco", "White Blend"),
    (1, "Portugal", "This is ripe\nand fruity.", "Avid", 90, 15.0, "Douro", None, "T2", "W1 2011 Avid Red", "Port Red"),
    (2, "US", "Tart and snappy.", None, 87, 14.0, "Oregon", "Willamette", "T3", "W2 2013 Pinot Gris", "Pinot Gris"),
    (3, "US", "Tart and snappy.", None, 87, 16.0, "Oregon", "Willamette", "T3", "W2 2013 Pinot Gris", "Pinot Gris"),
    (4, " US ", " Rich, complex and long. ", None, 95, 120.0, "California", "Napa", "T3", "W4 1999 Reserve 2005", "Cabernet"),
    (5, "US", "Rich, complex and long.", None, 95, 120.0, "California", "Napa", "T3", "W4 1999 Reserve 2005", "Cabernet"),
    (6, None, "Simple and short.", None, 82, 9.0, None, None, None, "W6 NV Brut", "Sparkling"),
    (7, "France", "Elegant, dense, ageworthy.", "Cru", 99, 3300.0, "Bordeaux", "Pauillac", "T2", "W7 2016 lot 2018", "Cabernet"),
    (8, "Spain", "Bitter notes.", None, 84, 15.0, "Rioja", "Rioja", None, "W8 2017 Joven", None),
    (9, "US", "Old and odd but fine.", "Solera", 90, 60.0, "California", None, "T3", "W9 1945 Solera", "Zinfandel"),
    (10, "Italy", "Lean.", "Riserva", 88, 60.0, "Tuscany", "Chianti", "T1", "W10 2010 Riserva", "Sangiovese"),
    (11, "France", "Beautiful and long, with great depth.", None, 93, None, "Burgundy", "Beaune", "T2", "W11 2012 Beaune", "Pinot Noir"),
]


def reviews_df(spark):
    rows = [dict(row_id=r[0], country=r[1], description=r[2], designation=r[3], points=r[4], price=r[5],
                 province=r[6], region_1=r[7], region_2=None, taster_name=r[8], taster_twitter_handle=None,
                 title=r[9], variety=r[10], winery="W") for r in REVIEWS]
    return spark.createDataFrame(rows, REVIEW_SCHEMA)


SCORES_Y = [0, 0, 1, 1, 0, 1, 1, 0]
SCORES_P = [0.1, 0.4, 0.35, 0.8, 0.5, 0.5, 0.9, 0.2]


def scores_df(spark, model="m"):
    return spark.createDataFrame([(model, i, y, p) for i, (y, p) in enumerate(zip(SCORES_Y, SCORES_P))],
                                 T.StructType([T.StructField("model", T.StringType()),
                                               T.StructField("row_id", T.LongType()),
                                               T.StructField("y", T.IntegerType()),
                                               T.StructField("p", T.DoubleType())]))
SF_SMALL = "/root/testdata/sf0.001"
