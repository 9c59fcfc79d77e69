"""Sheets filed under a domain by rules on their name, title and body."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.bind import let

#: domain, subdomain, keywords and dimension strategy of the rules, in order; fixed values.
RULES = [
    ("national_accounts", "gdp_current_price", ["gdp-hh", "gdp", "tong san pham trong nuoc theo gia hien hanh", "gia hien hanh"], "sector"),
    ("national_accounts", "gdp_constant_price", ["gdp-ss", "gdp", "gia so sanh", "tong san pham trong nuoc"], "sector"),
    ("agriculture_forestry_fishery", "agriculture", ["nong", "nn", "nong nghiep", "lua", "gieo cay", "thu hoach", "dong xuan", "channuoi", "lam nghiep", "thuy san", "nuoi trong"], "mixed_agri"),
    ("industry", "industrial_production_index", ["iip", "chi so san xuat cong nghiep", "gtcn", "gia tri san xuat cong nghiep", "cong nghiep"], "sector"),
    ("industry", "industrial_products", ["sp cn", "spcn", "san pham chu yeu", "san pham cong nghiep"], "product"),
    ("industry", "industrial_labor", ["ld cn", "ldcn", "lao dong cua doanh nghiep cong nghiep"], "mixed_geo_sector"),
    ("investment_construction", "investment", ["vdt", "von dau tu", "von nsnn", "xd", "xay dung", "dtnn", "fdi", "dt nn"], "mixed_geo_sector"),
    ("enterprise_business_registration", "enterprise_registration", ["dn", "doanh nghiep", "dang ky thanh lap", "quay lai", "ngung", "giai the"], "indicator"),
    ("retail_services_tourism", "retail_services", ["tongmuc", "tong muc", "tong muc ban le", "ban le", "dich vu", "luu tru", "an uong"], "sector"),
    ("retail_services_tourism", "tourism", ["du lich", "khach quoc te", "kqt"], "geography"),
    ("trade_prices", "exports", ["xuat khau", "xk", "export"], "product"),
    ("trade_prices", "imports", ["nhap khau", "nk", "import"], "product"),
    ("trade_prices", "consumer_price_index", ["cpi", "gia tieu dung", "lam phat"], "price_group"),
    ("trade_prices", "producer_price_index", ["gia sx", "gia san xuat", "gia van tai", "gia nvl", "gia xk", "gia nk", "tygia", "ty gia"], "price_group"),
    ("transport_post_telecom", "transport_passenger", ["van tai hk", "van tai hanh khach", "hanh khach", "vt hk", "vthk"], "transport_mode"),
    ("transport_post_telecom", "transport_freight", ["van tai hh", "van tai hang hoa", "vt hh", "vthh"], "transport_mode"),
    ("transport_post_telecom", "transport_freight", ["van tai", "vantai", "vt", "cuoc van tai", "buu chinh", "vien thong"], "transport_mode"),
    ("population_labor_social", "labor_social", ["laodong", "lao dong", "thatnghiep", "that nghiep", "danso", "dan so", "vieclam", "viec lam"], "indicator"),
    ("environment_safety_disaster", "social_environment",
     ["xhmt", "moi truong", "thien tai", "tai nan", "chay", "chay no", "vu no", "giao duc", "hoc sinh", "tot nghiep", "thpt", "y te", "benh vien", "van hoa", "the thao"], "indicator"),
]
#: Patterns on folded sheet names that decide alone; fixed values.
OVERRIDES = [
    (r"^\s*14\s*[._-]?\s*xk\b", "trade_prices", "exports", "product"),
    (r"^\s*15\s*[._-]?\s*nk\b", "trade_prices", "imports", "product"),
    (r"^\s*12\s*[._-]?\s*fdi\b", "investment_construction", "foreign_direct_investment", "sector"),
    (r"^\s*2\s*[._-]?\s*iip", "industry", "industrial_production_index", "sector"),
    (r"^\s*4\s*[._-]?\s*ldcn", "industry", "industrial_labor", "sector"),
]
#: Sheet names and their domains by the name alone; fixed values.
KNOWN_NAMES = [
    ("Vantai", "transport_post_telecom"), ("VT", "transport_post_telecom"), ("06VT", "transport_post_telecom"), ("VTHH", "transport_post_telecom"),
    ("VTHK", "transport_post_telecom"), ("VT-Ok", "transport_post_telecom"), ("18XK", "trade_prices"), ("26.NKthang", "trade_prices"), ("CPI", "trade_prices"),
    ("xuat khau thang", "trade_prices"), ("03SPCN", "industry"), ("02GTCN", "industry"), ("IIP", "industry"), ("Cong nghiep", "industry"), ("5. LDCN_DP", "industry"),
    ("5NN", "agriculture_forestry_fishery"), ("01NN", "agriculture_forestry_fishery"), ("05DTNN", "investment_construction"), ("11.VDT", "investment_construction"),
    ("Von dau tu", "investment_construction"), ("XD", "investment_construction"), ("04XD", "investment_construction"), ("DN1", "enterprise_business_registration"),
    ("16.DN giai the", "enterprise_business_registration"), ("Tongmuc", "retail_services_tourism"), ("Tong muc", "retail_services_tourism"), ("Du lich", "retail_services_tourism"),
    ("KQT", "retail_services_tourism"), ("GDP", "national_accounts"), ("1.GDP-HH", "national_accounts"), ("2.GDP-SS", "national_accounts"),
    ("LAO DONG", "population_labor_social"), ("Danso", "population_labor_social"), ("XHMT", "environment_safety_disaster"), ("THPT", "environment_safety_disaster"),
]

SHORT = 3
FALLBACK = "sheet_rule:fallback"


def keyword_pattern(keyword: str) -> str:
    """Short keywords must not follow a letter; longer ones match anywhere."""
    return (r"(?<![a-z])" if len(keyword) <= SHORT else "") + re.escape(keyword).replace(r"\ ", " ")


def classification(name: Column, title: Column, body: Column) -> Column:
    """struct<domain, subdomain, dimension_strategy, method, confidence, needs_review> from folded texts.

    Overrides on the name come first. Otherwise the rule with the best place (name, then title, then
    body), then the longest keyword, then the smallest number wins: the largest struct of all hits.
    """
    fields = ("domain", "subdomain", "dimension_strategy", "method", "confidence", "needs_review")
    fixed = lambda *values: F.struct(*[F.lit(v).alias(k) for k, v in zip(fields, values)])

    def decide(texts: Column) -> Column:
        hits = []
        for i, (_, _, keywords, _) in enumerate(RULES):
            for k in keywords:
                p = keyword_pattern(k)
                tier = F.when(texts["name"].rlike(p), 3).when(texts["title"].rlike(p), 2).when(texts["body"].rlike(p), 1)
                hits.append(F.struct(tier.alias("tier"), F.lit(len(k)).alias("span"), F.lit(-i).alias("rule")))
        out = None
        for pattern, domain, sub, strategy in OVERRIDES:
            value = fixed(domain, sub, strategy, f"sheet_name_override:{sub}", 1.0, False)
            out = F.when(texts["name"].rlike(pattern), value) if out is None else out.when(texts["name"].rlike(pattern), value)
        best = F.array_max(F.filter(F.array(*hits), lambda h: h["tier"].isNotNull()))
        return out.otherwise(let(best, filed))

    def filed(best: Column) -> Column:
        pick = lambda field: F.element_at(F.array(*[F.lit(r[field]) for r in RULES]), 1 - best["rule"])
        place = F.when(best["tier"] == 3, "name").when(best["tier"] == 2, "title").otherwise("body")
        sure = F.when(best["tier"] == 3, 0.95).when(best["tier"] == 2, 0.90).otherwise(0.70)
        method = F.concat(F.lit("sheet_rule:"), pick(1), F.lit(":"), place)
        ruled = F.struct(*[c.alias(k) for k, c in zip(fields, (pick(0), pick(1), pick(3), method, sure, best["tier"] == 1))])
        return F.when(best.isNotNull(), ruled).otherwise(fixed("other_or_unknown", "unknown", "indicator", FALLBACK, 0.35, True))

    texts = F.struct(F.coalesce(name, F.lit("")).alias("name"), F.coalesce(title, F.lit("")).alias("title"), F.coalesce(body, F.lit("")).alias("body"))
    return let(texts, decide)
