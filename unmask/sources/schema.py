"""Schemas of the product payload and of the wide snapshot table."""

from __future__ import annotations

from pyspark.sql import types as T

from unmask.functions.scalars import snake_case

# The five price kinds of a product and the fields of each.
PRICE_KINDS = ["singleprice", "promoprice", "caseprice", "inanysixprice", "webminqty"]
PRICE_FIELDS = ["Value", "BeforePromotion", "AfterPromotion", "Message", "IsMemberOffer"]

# Review fields in the payload and their column suffix.
REVIEW_FIELDS = {
    "author": "auth",
    "authorcontent": "authorcontent",
    "points": "points",
    "source": "source",
    "text": "text",
    "vintage": "vintage",
}
REVIEWS_KEPT = 2

# Top-level text, flag and count fields kept from a product; lists and records as JSON text.
TEXT_FIELDS = ["Stockcode", "Description", "RichDescription", "PackageSize", "UrlFriendlyName", "Unit", "Source",
               "ParentStockCode", "BackorderMessage", "SmallImageFile", "MediumImageFile", "LargeImageFile",
               "DeliveryOptionsInfo", "ProductsInSameOffer", "RecommendedProducts", "SavedLists"]
FLAG_FIELDS = ["AgeRestricted", "IsComingSoon", "IsDeliveryOnly", "IsEdrSpecial", "IsFeaturedTag",
               "IsFindMeAvailable", "IsForCollection", "IsForDelivery", "IsInDefaultList", "IsInTrolley",
               "IsInWishList", "IsMemberSpecial", "IsNew", "IsOnSpecial", "IsPreSale", "IsPurchasable",
               "ShouldShowFindMeCta"]
COUNT_FIELDS = ["StockOnHand", "BackorderStockOnHand", "DisplayQuantity", "MinimumQuantity", "NumberOfReviews",
                "QuantityInTrolley", "SupplyLimit"]
NUMBER_FIELDS = ["OverallRating"]

# Fields of the stock record, whole numbers, flags and messages.
STOCK_COUNTS = ["availableinventoryqty", "backorderavailableinventoryqty", "onlineinventoryqty",
                "clickandcollect2hrsinventoryqty", "clickandcollect7daysinventoryqty", "findinstoreinventoryqty",
                "nextdaydeliveryinventoryqty", "pickadaydeliveryinventoryqty", "samedaydeliveryinventoryqty"]
STOCK_FLAGS = ["backorderinventoryflag", "isfindme2hrsinventoryavailable", "isfindme7daysinventoryavailable",
               "isfindmedeliveryinventoryavailable"]
STOCK_MESSAGES = ["clickandcollect2hrsinventoryqtymessage", "clickandcollect7daysinventoryqtymessage",
                  "findinstoreinventoryqtymessage", "nextdaydeliveryinventoryqtymessage",
                  "pickadaydeliveryinventoryqtymessage", "samedaydeliveryinventoryqtymessage"]
PICKUP_FIELDS = ["Available", "DistanceFromDeliveryLocation", "StoreName", "StoreNo"]

# Names of the free attributes that become columns.
ATTRIBUTES = [
    "age", "awardwinner", "brewery", "cidertype", "corkscoreeligible", "countryoforigin", "dm_stockcode",
    "extbeerid", "glutenfree", "ibu", "image1", "image2", "image3", "image4", "isvintagerollingorstatic",
    "preservativefree", "product_short_name", "producttitle", "standarddrinks", "varietal",
    "webalcoholpercentage", "webaverageproductrating", "webbadgescollection", "webbadgescollection2",
    "webbeerstyle", "webbottleclosure", "webbrandname", "webbrewedunderlicense", "webbundleenddate",
    "webbundleexpandincart", "webbundleskucomponent", "webbundleskuquantity", "webbundlestartdate",
    "webciderstyle", "webcountryoforigin", "webdescriptionshort", "webdsvflag", "webdsvname",
    "webdsvvendorid", "webfoodmatch", "webisorganic", "webisvegan", "weblangtonsclassification",
    "webliquorsize", "webmaincategory", "webmaxquantity", "webminquantity", "webpacksizecase",
    "webpacksizeinner", "webpacktype", "webpresaledmmaxqtylimit", "webpresaleenddate", "webpresaleflag",
    "webpresalemarketlaunchdate", "webpresalemdmmaxqtylimit", "webpresaleorderreleasedate",
    "webpresalestartdate", "webpresaleusermaxqtylimit", "webproductcanbechilled", "webproductname",
    "webproductsale", "webproducttype", "webpromomdmmessage", "webpromomessage", "webpromomessageenddt",
    "webpromomessagestartdt", "webpromosecondmesgenddt", "webpromosecondmesgstartdt",
    "webpromosecondmessage", "webpromotionalbundle", "webregionoforigin", "webreviewrating",
    "webspiritstyle", "webstateoforigin", "webtitle", "webtotalreviewcount", "webvideourl",
    "webvintagecurrent", "webvintagenote", "webwhiskystyle", "webwinebody", "webwinemaker", "webwinestyle",
]

MONEY = T.DecimalType(12, 2)


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


def price_type() -> T.StructType:
    kinds = {"Message": T.StringType(), "IsMemberOffer": T.BooleanType()}
    return _struct([(f, kinds.get(f, MONEY)) for f in PRICE_FIELDS])


def inventory_type() -> T.StructType:
    fields: list[tuple[str, T.DataType]] = [(c, T.LongType()) for c in STOCK_COUNTS]
    fields += [(c, T.BooleanType()) for c in STOCK_FLAGS]
    return _struct(fields + [(c, T.StringType()) for c in STOCK_MESSAGES])


CATEGORIES = T.ArrayType(_struct([("UrlFriendlyName", T.StringType())]))
REVIEWS = T.ArrayType(_struct([(f, _struct([("Value", T.StringType())])) for f in REVIEW_FIELDS]))
DETAILS = T.ArrayType(
    _struct([("Name", T.StringType()), ("Value", T.StringType()), ("DisplayName", T.StringType())])
)

PRODUCT = _struct(
    [(f, T.StringType()) for f in TEXT_FIELDS]
    + [(f, T.BooleanType()) for f in FLAG_FIELDS]
    + [(f, T.LongType()) for f in COUNT_FIELDS]
    + [(f, T.DoubleType()) for f in NUMBER_FIELDS]
    + [
        ("Categories", CATEGORIES),
        ("Reviews", REVIEWS),
        ("AdditionalDetails", DETAILS),
        ("Prices", _struct([(k, price_type()) for k in PRICE_KINDS])),
        ("Inventory", inventory_type()),
        ("PickupStoreInventoryInfo", _struct([(f, T.StringType()) for f in PICKUP_FIELDS])),
    ]
)
PAYLOAD = _struct([("Products", T.ArrayType(PRODUCT))])


def flat_name(*parts: str) -> str:
    return "_".join(snake_case(p) for p in parts)


def review_columns() -> list[str]:
    return [f"review{i + 1}_{s}" for i in range(REVIEWS_KEPT) for s in REVIEW_FIELDS.values()]


def snapshot_schema(attributes: list[str] | None = None) -> T.StructType:
    """The wide table: one row per product and load."""
    text = T.StringType()
    fields: list[tuple[str, T.DataType]] = [(flat_name(f), text) for f in TEXT_FIELDS]
    fields += [(flat_name(f), T.BooleanType()) for f in FLAG_FIELDS]
    fields += [(flat_name(f), T.LongType()) for f in COUNT_FIELDS]
    fields += [(flat_name(f), T.DoubleType()) for f in NUMBER_FIELDS]
    fields += [("category", text), ("sub_category", text)]
    fields += [(c, text) for c in review_columns()]
    for kind in PRICE_KINDS:
        fields += [(flat_name("price", kind, f.name), f.dataType) for f in price_type().fields]
    fields += [("inventory", text)]
    fields += [(flat_name("inventory", f.name), f.dataType) for f in inventory_type().fields]
    fields += [(flat_name("pickup", f), text) for f in PICKUP_FIELDS]
    fields += [(flat_name(a), text) for a in (ATTRIBUTES if attributes is None else attributes)]
    fields += [("mystery", T.BooleanType()), ("load_ts", T.TimestampType()), ("run_date", T.DateType())]
    return _struct(fields)
