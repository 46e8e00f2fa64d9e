"""Segment campaign copy (K5-K7).

Campaign inputs are derived from the data per segment (favourite category,
average order value, prevailing risk band); the copy itself is a rule-based
template chosen by the segment name.  One row per segment; the same
expressions work per customer at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import fixed as fixed_places
from tillroll.functions.money import cents_to_double, div_round, to_cents

# The three rule branches of the campaign template
# (subject, offer, body, call to action), with %s slots for the inputs.
VIP_SUBJECT = "Exclusive VIP Perk: Preview our latest %s collection"
VIP_OFFER = "20% Exclusive Rewards Voucher + Priority Customer Support"
VIP_BODY = ("As one of our premier VIP customers (with average orders around $%s), we want to personally "
            "thank you for your loyalty. We've reserved early access for our newest arrivals in %s.")
VIP_CTA = "Access VIP Perks Now"
RISK_SUBJECT = "We miss you! Here is $25 off your next %s purchase"
RISK_OFFER = "$25 Instant Credit + Free Express Shipping on orders over $50"
RISK_BODY = ("We noticed it's been a while since your last visit. We've added a special credit to your "
             "account to help you get back to shopping your favorites in %s.")
RISK_CTA = "Claim My $25 Credit"
OTHER_SUBJECT = "Special Offer on %s just for you!"
OTHER_OFFER = "15% Off Your Next Order (Code: SAVE15)"
OTHER_BODY = ("Thank you for being a valued customer. Explore our top-rated trending products in %s "
              "and enjoy 15% off your next purchase.")
OTHER_CTA = "Shop Trending Products"
TEMPLATE = """### Campaign Strategy: %s

* **Target Audience:** Customers categorized as '%s' with %s churn risk.
* **Email Subject Line:** %s

* **Email Body:**  
  Dear Customer,

  %s

  Don't miss out on exploring our curated selections designed to bring you the best value.

  Warm regards,  
  The E-Commerce Customer Care Team

* **Incentive / Promo Code:** %s
* **Call to Action (CTA):** [%s]
"""


def slug(col) -> F.Column:
    """Lower-case, ' ' -> '_', then '/' removed, then '-' -> '_'."""
    c = F.col(col) if isinstance(col, str) else col
    return F.replace(F.replace(F.replace(F.lower(c), F.lit(" "), F.lit("_")), F.lit("/"), F.lit("")),
                     F.lit("-"), F.lit("_"))


def inputs(segments: DataFrame, scored: DataFrame) -> DataFrame:
    """K6: per segment the favourite category (mode, lowest on ties), the
    average order value (2 dp, half-even) and the prevailing risk band."""
    joined = segments.select("CustomerID", "CustomerSegment", "PrimaryCategory", "AvgOrderValue").join(
        scored.select("CustomerID", "RiskCategory"), "CustomerID")
    agg = joined.groupBy("CustomerSegment").agg(
        F.mode("PrimaryCategory", True).alias("FavoriteCategory"),
        F.sum("AvgOrderValue").alias("_s"), F.count("AvgOrderValue").alias("_n"),
        F.mode("RiskCategory", True).alias("ChurnRisk"))
    return agg.select("CustomerSegment", "FavoriteCategory",
                      cents_to_double(div_round(to_cents("_s"), "_n", "half_even")).alias("AvgSpend"),
                      "ChurnRisk")


def _fmt(template: str) -> str:
    """Escape literal percent signs, keeping the %s slots."""
    return template.replace("%", "%%").replace("%%s", "%s")


def copy(inp: DataFrame) -> DataFrame:
    """K5: subject, offer, body, call to action and the assembled text."""
    seg, cat = F.col("CustomerSegment"), F.col("FavoriteCategory")
    spend = fixed_places(F.col("AvgSpend"), 2)
    vip = seg.contains("VIP")
    risk = seg.contains("At-Risk") | seg.contains("Inactive")

    def pick(a, b, c):
        return F.when(vip, a).when(risk, b).otherwise(c)

    subject = pick(F.format_string(_fmt(VIP_SUBJECT), cat), F.format_string(_fmt(RISK_SUBJECT), cat),
                   F.format_string(_fmt(OTHER_SUBJECT), cat))
    offer = pick(F.lit(VIP_OFFER), F.lit(RISK_OFFER), F.lit(OTHER_OFFER))
    body = pick(F.format_string(_fmt(VIP_BODY), spend, cat), F.format_string(_fmt(RISK_BODY), cat),
                F.format_string(_fmt(OTHER_BODY), cat))
    cta = pick(F.lit(VIP_CTA), F.lit(RISK_CTA), F.lit(OTHER_CTA))
    out = inp.select("*", subject.alias("Subject"), offer.alias("Offer"), body.alias("Body"),
                     cta.alias("CallToAction"))
    text = F.format_string(_fmt(TEMPLATE),
                           seg, seg, F.col("ChurnRisk"), F.col("Subject"), F.col("Body"),
                           F.col("Offer"), F.col("CallToAction"))
    return out.withColumn("Slug", slug(seg)).withColumn("Text", text)
