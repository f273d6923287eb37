"""Rule sets checked by the context_fallback oracle (same order as the Spark query)."""

from .. import fixed_values as fv

RULE_SETS = {"gdn": fv.GDN_RULES, "facebook": fv.FACEBOOK_RULES, "pinterest": fv.PINTEREST_RULES,
             "snapchat": fv.SNAPCHAT_RULES, "tiktok": fv.TIKTOK_RULES}
