"""Fixed values.

Every literal below must equal the value used by the report definitions this
library re-implements: campaign-id markers, planning-context fallbacks, lineage
labels, recodings, fee rates and catalogue rules. They are kept here, together
and in the order the reports use them, so that the operators stay free of
magic strings.
"""

# ---------------------------------------------------------------- FIXED VALUES
# campaign-id markers for the budget logic
MARK_TW = "-TW.BC-"
MARK_PF = "-PF.BC-"
MARK_W = "-W.BC-"
MARK_F = "-F.BC-"
MARK_SS_AG = "-SS.AG-"
MARK_D_C = "-D.C-"
MARK_SES = "-SES.C-"
# budget share: percentage before ".WS" or ".FS"
SHARE_WS_MARK = ".WS-"
SHARE_WS_RE = r"(\d+)\.WS"
SHARE_FS_MARK = ".FS-"
SHARE_FS_RE = r"(\d+)\.FS"
DIGITS_RE = r"\d+"
# final exclusions of the sea and social views
SEA_EXCLUDE_MARK = "B.AC"
SOCIAL_EXCLUDE_MARK = "B.AC-"
# social inclusion marker on CAMP_ID and the name marker
SOCIAL_MARK = "-SA.C-"
PERFORMANCE = "PERFORMANCE"
WKZ = "WKZ"

# channel fallbacks
CH_AFFILIATES = "Affiliates"
CH_SEA = "SEA"
CH_DISPLAY = "Display Advertising"
CH_SOCIAL = "Social Ads"

# planning context fallbacks (code, name)
PC_AWIN = ("AN.MP-A.C", "AWIN")
PC_PRIVATE_NETWORK = ("PN.MP-A.C", "Private Network")
AFF_CLICK_CONTEXT_NAMES = ("Private Network", "AWIN")
PC_GOOGLE_KEYWORD = ("G.MP-A.AS-S.C", "Google AdWords")
PC_GOOGLE_DSA = ("G.MP-DS.AS-S.C", "Google DSA")
PC_BING_KEYWORD = ("B.MP-BA.AS-S.C", "Bing Ads")
PC_BING_DSA = ("B.MP-BD.AS-S.C", "Bing DSA")
PC_GOOGLE_ACE = ("G.MP-GAC.AS-RTG.BT-D.C", "Retargeting Google ACe")
PC_YOUTUBE = ("Y.MP-GV.AS-SA.C", "YouTube - Google Video")

# context fallback rules from campaign name or account, first matching arm wins.
# has: all contained, lacks: none contained, accounts: config fields compared by
# equality (OR-ed with the text condition). upper: compare on UPPER(name).
GDN_RULES = dict(upper=False, arms=[
    dict(has=("CLT",), code="G.MP-GD.AS-CLT.BT-D.C", name="CLT GDN"),
    dict(has=("Retargeting",), code="G.MP-GD.AS-RTG.BT-D.C", name="Retargeting GDN"),
    dict(has=("REW",), code="G.MP-GD.AS-REW.BT-D.C", name="Reichweite GDN"),
    dict(has=("WKZ",), code="G.MP-GD.AS-REW.BT-D.C", name="Reichweite GDN"),
])
FACEBOOK_RULES = dict(upper=True, arms=[
    dict(has=("APP INSTALL", "RETARGETING"), code="F.MP-DP.AS-APP.BT-OA.T-SA.C", name="Facebook App Install Dynamic Ads"),
    dict(has=("APP INSTALL",), lacks=("RETARGETING",), code="F.MP-FS.AS-APP.BT-OA.T-SA.C", name="Facebook App Install Static Ads"),
    dict(has=("RETARGETING",), code="F.MP-DP.AS-SA.C", name="Facebook Dynamic Ads"),
    dict(has=("WEB PROSPECTING",), code="F.MP-FS.AS-SA.C", name="Facebook Static Ads"),
])
PINTEREST_RULES = dict(upper=True, arms=[
    dict(has=("PERFORMANCE", "TRAFFIC"), code="P.MP-PS.AS-SA.C", name="Pinterest Static"),
    dict(has=("PERFORMANCE", "CONVERSION"), code="P.MP-PF.AS-SA.C", name="Pinterest Product Feed"),
])
SNAPCHAT_RULES = dict(upper=True, arms=[
    dict(has=("PERFORMANCE", "DYNAMISCH"), code="SN.MP-D.AS-SA.C", name="Snapchat Dynamic Ads"),
    dict(has=("PERFORMANCE", "APP INSTALL"), code="SN.MP-S.AS-APP.BT-SA.C", name="Snapchat Static App Install"),
])
TIKTOK_RULES = dict(upper=True, arms=[
    dict(has=("APP INSTALL",), accounts=("tiktok_app_install_account",), code="TI.MP-S.AS-APP.BT-SA.C", name="TikTok Static App Install"),
    dict(accounts=("tiktok_static_account",), code="TI.MP-S.AS-SA.C", name="TikTok Static Ads"),
    dict(accounts=("tiktok_dynamic_account",), code="TI.MP-D.AS-SA.C", name="TikTok Dynamic Ads"),
])

# logical sources named by the lineage labels
SRC_AFF_AWIN = "affiliate_costs_awin"
SRC_AFF_PRIVATE_NETWORK = "affiliate_costs_private_network"
SRC_AFF_FIXCOST = "affiliate_fixcost"
SRC_AFF_CLICKS = "tracking_calls"
SRC_GOOGLE_KEYWORD = "google_keyword_perf"
SRC_GOOGLE_DSA = "google_dsa_perf"
SRC_BING_KEYWORD = "bing_keyword_perf"
SRC_BING_DSA = "bing_dsa_perf"
SRC_ADITION = "adition_display_perf"
SRC_ADITION_PARTNER = "adition_partner_perf"
SRC_GOOGLE_ACE = "google_ads_ad_perf"
SRC_GOOGLE_AD = "google_ad_perf"
SRC_ODIN = "odin_ad_perf"
SRC_BING_AUDIENCE = "bing_ad_perf"
SRC_FACEBOOK = "facebook_ad_perf"
SRC_PINTEREST = "pinterest_pin_perf"
SRC_SNAPCHAT = "snap_ad_perf"
SRC_TIKTOK = "tiktok_ad_perf"
SRC_TV = "tv_flights"
SRC_RADIO = "radio_marketer"
SRC_WEBRADIO = "radio_webradio"
SRC_DIGITAL = "digital_mediaplan"
SRC_DOOH = "dooh_perf"

# branding: channels, campaign types, name markers
CH_TV = "TV"
CH_AUDIO = "Audio"
CH_DOOH = "(Digital) Out Of Home"
CH_DISPLAY_BRANDING = "Display Branding"
CH_SOCIAL_BRANDING = "Social Ads Branding"
CH_ONLINE_VIDEO = "Online Video"
TYPE_VERTRIEB = "VERTRIEB"
TYPE_BRANDING = "BRANDING"
NAME_WKZ = "_WKZ_"
NAME_VERTRIEB = "_VERTRIEB_"
NAME_VERTRIEB_DOOH = "_VERTRIEB"
ORIGIN_WKZ = "WKZ"
ORIGIN_VERTRIEB = "VERTRIEB"
SCOPE_WKZ = "WKZ"
SCOPE_VERTRIEB = "Vertrieb"
# plan channels (compared on UPPER) and fee channels
PLAN_TV = "TV"
PLAN_RADIO = "HÖRFUNK"
PLAN_WEBRADIO = "WEBRADIO"
FEE_TV = "TV"
FEE_FUNK = "FUNK"
FEE_DIGITAL = "DIGITAL"
FEE_DOOH = "(D)OOH"
# digital media plan: channel and media type recoding, scope and type filters
DIGITAL_CHANNEL_RECODE = [("ATV", "Adressable TV"), ("OLV", "Online Video"), ("DISPLAY BRANDING", "Display Branding")]
DIGITAL_MEDIA_TYPE_RECODE = [("ADDRESSABLE TV", "IO"), ("DISPLAY", "IO"), ("OLV", "IO"), ("PAID MOBILE", "IO"), ("PROGRAMMATIC", "PROGRAMMATIC")]
DIGITAL_MEDIA_TYPE_OTHER = "OTHER"
DIGITAL_SCOPES = ("BRANDING", "WKZ", "VERTRIEB")
DIGITAL_EXCLUDED_MEDIA_TYPE = "DIGITAL RADIO"
DIGITAL_EXCLUDED_CREATIVE_TYPE = "SONDERKOMBINATION"
BILLING_CPM = "CPM"
BILLING_VCPM = "vCPM"
BILLING_CPC = "CPC"
# out of home
DOOH_PROGRAMMATIC_MARK = "PROGR."
DOOH_PROGRAMMATIC = "PROGRAMMATIC (D)OOH"
DOOH_PLAIN = "(D)OOH"
DOOH_EXCLUDED_COST_TYPES = (
    "FOTO DOKU", "GENEHMIGUNG", "JVB HONORAR PRODUKTION", "LEISTUNGSHONORAR", "PRODUKTION ANALOG",
    "PRODUKTION DIGITAL", "SONSTIGES", "STORNOGEBUEHR", "VERSAND",
)
# in-house fees: platform 5 % of spend plus 0.006 USD per 1000 impressions; tool fee 1.5 %
ODIN_SPEND_FEE = "0.05"
ODIN_USD_PER_MILLE = "0.006"
TOOL_FEE = "0.015"

# seasonal catalogue cost
CATALOG_PROJECT_MATCH = r"^\d{2}GJ_.*"
CATALOG_PROJECT_PATTERN = r"(?:^[^_]+_)([^_\n]+)(?:_*.*)"
CATALOG_SEASON_RE = r"^\d\d"
CATALOG_PACKAGE = "Package"
CATALOG_PACKAGE_EXTRA = 5
CATALOG_WEIGHT_FACTOR = "1.04"
CATALOG_SOURCES = ("OPP Creation", "PPC Creative", "OPP Shipping")
# ------------------------------------------------------------ END FIXED VALUES
