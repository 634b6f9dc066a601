"""Fixed values.

Everything in this module is data, not logic: names, tag lists, codes and thresholds that have to be
exactly these for results to agree with published filings and with the yardstick numbers. Override any of
them through :class:`ledgermill.settings.Settings`.
"""

# --- fixed values: canonical metrics, datatype, statement and tags in priority order -----------------------
METRICS = {
    "revenue": {
        "datatype": "monetary",
        "statement": "IS",
        "tags": [
            "Revenues",
            "RevenueFromContractWithCustomerExcludingAssessedTax",
            "RevenueFromContractWithCustomerIncludingAssessedTax",
            "SalesRevenueNet",
            "SalesRevenueGoodsNet",
            "RevenuesNetOfInterestExpense",
            "RegulatedAndUnregulatedOperatingRevenue",
            "InterestAndDividendIncomeOperating",
            "GrossInvestmentIncomeOperating",
        ],
    },
    "cost_of_revenue": {
        "datatype": "monetary",
        "statement": "IS",
        "tags": [
            "CostOfRevenue",
            "CostOfGoodsAndServicesSold",
            "CostOfGoodsAndServiceExcludingDepreciationDepletionAndAmortization",
            "CostOfGoodsSold",
            "CostOfServices",
            "CostOfGoodsSoldExcludingDepreciationDepletionAndAmortization",
        ],
    },
    "gross_profit": {
        "datatype": "monetary",
        "statement": "IS",
        "tags": [
            "GrossProfit",
        ],
    },
    "operating_income": {
        "datatype": "monetary",
        "statement": "IS",
        "tags": [
            "OperatingIncomeLoss",
        ],
    },
    "net_income": {
        "datatype": "monetary",
        "statement": "IS",
        "tags": [
            "NetIncomeLoss",
            "ProfitLoss",
            "NetIncomeLossAvailableToCommonStockholdersBasic",
            "IncomeLossFromContinuingOperations",
        ],
    },
    "total_assets": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "Assets",
        ],
    },
    "current_assets": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "AssetsCurrent",
        ],
    },
    "current_liabilities": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "LiabilitiesCurrent",
        ],
    },
    "total_liabilities": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "Liabilities",
        ],
    },
    "liabilities_and_equity": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "LiabilitiesAndStockholdersEquity",
        ],
    },
    "equity_parent": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "StockholdersEquity",
            "PartnersCapital",
            "MembersEquity",
            "CommonStockholdersEquity",
        ],
    },
    "equity_incl_nci": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
            "PartnersCapitalIncludingPortionAttributableToNoncontrollingInterest",
        ],
    },
    "minority_interest": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "MinorityInterest",
        ],
    },
    "temporary_equity": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "TemporaryEquityCarryingAmountAttributableToParent",
            "TemporaryEquityCarryingAmountIncludingPortionAttributableToNoncontrollingInterest",
            "RedeemableNoncontrollingInterestEquityCarryingAmount",
        ],
    },
    "cash": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "CashAndCashEquivalentsAtCarryingValue",
            "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents",
            "Cash",
            "CashAndDueFromBanks",
        ],
    },
    "short_term_investments": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "ShortTermInvestments",
            "MarketableSecuritiesCurrent",
            "AvailableForSaleSecuritiesDebtSecuritiesCurrent",
            "CashCashEquivalentsAndShortTermInvestments",
        ],
    },
    "receivables": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "AccountsReceivableNetCurrent",
            "ReceivablesNetCurrent",
            "AccountsNotesAndLoansReceivableNetCurrent",
        ],
    },
    "inventory": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "InventoryNet",
            "InventoryFinishedGoodsNetOfReserves",
        ],
    },
    "ltd_current": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "LongTermDebtCurrent",
            "LongTermDebtAndCapitalLeaseObligationsCurrent",
            "LongTermDebtAndFinanceLeaseObligationsCurrent",
        ],
    },
    "ltd_noncurrent": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "LongTermDebtNoncurrent",
            "LongTermDebtAndCapitalLeaseObligations",
            "LongTermDebtAndFinanceLeaseObligationsNoncurrent",
            "LongTermDebt",
        ],
    },
    "short_term_borrowings": {
        "datatype": "monetary",
        "statement": "BS",
        "tags": [
            "ShortTermBorrowings",
            "CommercialPaper",
            "LinesOfCreditCurrent",
            "NotesPayableCurrent",
        ],
    },
    "operating_cash_flow": {
        "datatype": "monetary",
        "statement": "CF",
        "tags": [
            "NetCashProvidedByUsedInOperatingActivities",
            "NetCashProvidedByUsedInOperatingActivitiesContinuingOperations",
        ],
    },
    "investing_cash_flow": {
        "datatype": "monetary",
        "statement": "CF",
        "tags": [
            "NetCashProvidedByUsedInInvestingActivities",
            "NetCashProvidedByUsedInInvestingActivitiesContinuingOperations",
        ],
    },
    "financing_cash_flow": {
        "datatype": "monetary",
        "statement": "CF",
        "tags": [
            "NetCashProvidedByUsedInFinancingActivities",
            "NetCashProvidedByUsedInFinancingActivitiesContinuingOperations",
        ],
    },
    "capex": {
        "datatype": "monetary",
        "statement": "CF",
        "tags": [
            "PaymentsToAcquirePropertyPlantAndEquipment",
            "PaymentsToAcquireProductiveAssets",
            "PaymentsToAcquireOtherPropertyPlantAndEquipment",
            "PaymentsForCapitalImprovements",
        ],
    },
    "cash_change_incl_fx": {
        "datatype": "monetary",
        "statement": "CF",
        "tags": [
            "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalentsPeriodIncreaseDecreaseIncludingExchangeRateEffect",
            "CashAndCashEquivalentsPeriodIncreaseDecrease",
        ],
    },
    "cash_change_excl_fx": {
        "datatype": "monetary",
        "statement": "CF",
        "tags": [
            "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalentsPeriodIncreaseDecreaseExcludingExchangeRateEffect",
            "CashAndCashEquivalentsPeriodIncreaseDecreaseExcludingExchangeRateEffect",
        ],
    },
    "fx_effect": {
        "datatype": "monetary",
        "statement": "CF",
        "tags": [
            "EffectOfExchangeRateOnCashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents",
            "EffectOfExchangeRateOnCashAndCashEquivalents",
            "EffectOfExchangeRateOnCashCashEquivalentsRestrictedCashAndRestrictedCashEquivalentsIncludingDisposalGroupAndDiscontinuedOperations",
        ],
    },
    "shares_outstanding": {
        "datatype": "shares",
        "statement": "DEI",
        "tags": [
            "dei:EntityCommonStockSharesOutstanding",
            "CommonStockSharesOutstanding",
        ],
    },
    "weighted_shares_basic": {
        "datatype": "shares",
        "statement": "IS",
        "tags": [
            "WeightedAverageNumberOfSharesOutstandingBasic",
            "WeightedAverageNumberOfShareOutstandingBasicAndDiluted",
        ],
    },
    "weighted_shares_diluted": {
        "datatype": "shares",
        "statement": "IS",
        "tags": [
            "WeightedAverageNumberOfDilutedSharesOutstanding",
            "WeightedAverageNumberOfShareOutstandingBasicAndDiluted",
        ],
    },
    "eps_basic": {
        "datatype": "perShare",
        "statement": "IS",
        "tags": [
            "EarningsPerShareBasic",
            "EarningsPerShareBasicAndDiluted",
        ],
    },
    "eps_diluted": {
        "datatype": "perShare",
        "statement": "IS",
        "tags": [
            "EarningsPerShareDiluted",
            "EarningsPerShareBasicAndDiluted",
        ],
    },
}

# --- fixed values: derivations, applied in this order ------------------------------------------------------
DERIVATIONS = [
    {
        "metric": "equity_parent",
        "formula": "+equity_incl_nci -minority_interest",
        "optional": ["minority_interest"],
        "reason": "derived_equity_incl_nci_minus_minority_interest",
    },
    {
        "metric": "gross_profit",
        "formula": "+revenue -cost_of_revenue",
        "optional": [],
        "reason": "derived_revenue_minus_cost_of_revenue",
    },
    {
        "metric": "equity_incl_nci",
        "formula": "+equity_parent +minority_interest",
        "optional": ["minority_interest"],
        "reason": "derived_equity_parent_plus_minority_interest",
    },
    {
        "metric": "total_liabilities",
        "formula": "+liabilities_and_equity -equity_incl_nci -temporary_equity",
        "optional": ["temporary_equity"],
        "reason": "derived_from_liabilities_and_equity",
    },
]

# --- fixed values: ratio names, formula, inputs, kind and unit ---------------------------------------------
RATIOS = {
    "gross_margin": {
        "formula": "(revenue - cost_of_revenue) / revenue, or gross_profit / revenue",
        "inputs": ["revenue", "cost_of_revenue", "gross_profit"],
        "kind": "flow",
        "unit": "ratio",
    },
    "operating_margin": {
        "formula": "operating_income / revenue",
        "inputs": ["operating_income", "revenue"],
        "kind": "flow",
        "unit": "ratio",
    },
    "net_margin": {
        "formula": "net_income / revenue",
        "inputs": ["net_income", "revenue"],
        "kind": "flow",
        "unit": "ratio",
    },
    "current_ratio": {
        "formula": "current_assets / current_liabilities",
        "inputs": ["current_assets", "current_liabilities"],
        "kind": "instant",
        "unit": "ratio",
    },
    "quick_ratio": {
        "formula": "(current_assets - inventory) / current_liabilities",
        "inputs": ["current_assets", "inventory", "current_liabilities"],
        "kind": "instant",
        "unit": "ratio",
    },
    "debt_to_equity": {
        "formula": "(short_term_borrowings + ltd_current + ltd_noncurrent) / equity_parent",
        "inputs": ["short_term_borrowings", "ltd_current", "ltd_noncurrent", "equity_parent"],
        "kind": "instant",
        "unit": "ratio",
    },
    "liabilities_to_equity": {
        "formula": "total_liabilities / equity_parent",
        "inputs": ["total_liabilities", "equity_parent"],
        "kind": "instant",
        "unit": "ratio",
    },
    "roa": {
        "formula": "net_income / total_assets",
        "inputs": ["net_income", "total_assets"],
        "kind": "mixed",
        "unit": "ratio",
    },
    "roe": {
        "formula": "net_income / equity_parent",
        "inputs": ["net_income", "equity_parent"],
        "kind": "mixed",
        "unit": "ratio",
    },
    "asset_turnover": {
        "formula": "revenue / total_assets",
        "inputs": ["revenue", "total_assets"],
        "kind": "mixed",
        "unit": "ratio",
    },
    "free_cash_flow": {
        "formula": "operating_cash_flow - capex",
        "inputs": ["operating_cash_flow", "capex"],
        "kind": "flow",
        "unit": "currency",
    },
    "working_capital": {
        "formula": "current_assets - current_liabilities",
        "inputs": ["current_assets", "current_liabilities"],
        "kind": "instant",
        "unit": "currency",
    },
    "yoy_revenue_growth": {
        "formula": "revenue / revenue_prior_year - 1",
        "inputs": ["revenue", "revenue_prior_year"],
        "kind": "flow",
        "unit": "ratio",
    },
}

# --- fixed values: standard industrial classification ------------------------------------------------------
SIC_DIVISIONS = [
    ("A", "Agriculture, Forestry & Fishing", 100, 999),
    ("B", "Mining", 1000, 1499),
    ("C", "Construction", 1500, 1799),
    ("D", "Manufacturing", 2000, 3999),
    ("E", "Transportation, Communications & Utilities", 4000, 4999),
    ("F", "Wholesale Trade", 5000, 5199),
    ("G", "Retail Trade", 5200, 5999),
    ("H", "Finance, Insurance & Real Estate", 6000, 6799),
    ("I", "Services", 7000, 8999),
    ("J", "Public Administration", 9100, 9999),
]

SIC_MAJOR_GROUPS = {
    1: "Agricultural Production - Crops",
    2: "Agricultural Production - Livestock",
    7: "Agricultural Services",
    8: "Forestry",
    9: "Fishing, Hunting & Trapping",
    10: "Metal Mining",
    12: "Coal Mining",
    13: "Oil & Gas Extraction",
    14: "Nonmetallic Minerals, Except Fuels",
    15: "General Building Contractors",
    16: "Heavy Construction, Except Building",
    17: "Special Trade Contractors",
    20: "Food & Kindred Products",
    21: "Tobacco Products",
    22: "Textile Mill Products",
    23: "Apparel & Other Textile Products",
    24: "Lumber & Wood Products",
    25: "Furniture & Fixtures",
    26: "Paper & Allied Products",
    27: "Printing & Publishing",
    28: "Chemicals & Allied Products",
    29: "Petroleum & Coal Products",
    30: "Rubber & Miscellaneous Plastics Products",
    31: "Leather & Leather Products",
    32: "Stone, Clay & Glass Products",
    33: "Primary Metal Industries",
    34: "Fabricated Metal Products",
    35: "Industrial Machinery & Equipment",
    36: "Electronic & Other Electric Equipment",
    37: "Transportation Equipment",
    38: "Instruments & Related Products",
    39: "Miscellaneous Manufacturing Industries",
    40: "Railroad Transportation",
    41: "Local & Interurban Passenger Transit",
    42: "Trucking & Warehousing",
    43: "U.S. Postal Service",
    44: "Water Transportation",
    45: "Transportation by Air",
    46: "Pipelines, Except Natural Gas",
    47: "Transportation Services",
    48: "Communications",
    49: "Electric, Gas & Sanitary Services",
    50: "Wholesale Trade - Durable Goods",
    51: "Wholesale Trade - Nondurable Goods",
    52: "Building Materials & Garden Supplies",
    53: "General Merchandise Stores",
    54: "Food Stores",
    55: "Automotive Dealers & Service Stations",
    56: "Apparel & Accessory Stores",
    57: "Furniture & Home Furnishings Stores",
    58: "Eating & Drinking Places",
    59: "Miscellaneous Retail",
    60: "Depository Institutions",
    61: "Nondepository Institutions",
    62: "Security & Commodity Brokers",
    63: "Insurance Carriers",
    64: "Insurance Agents, Brokers & Service",
    65: "Real Estate",
    67: "Holding & Other Investment Offices",
    70: "Hotels & Other Lodging Places",
    72: "Personal Services",
    73: "Business Services",
    75: "Auto Repair, Services & Parking",
    76: "Miscellaneous Repair Services",
    78: "Motion Pictures",
    79: "Amusement & Recreation Services",
    80: "Health Services",
    81: "Legal Services",
    82: "Educational Services",
    83: "Social Services",
    84: "Museums, Botanical, Zoological Gardens",
    86: "Membership Organizations",
    87: "Engineering & Management Services",
    88: "Private Households",
    89: "Services, Not Elsewhere Classified",
    91: "Executive, Legislative & General",
    92: "Justice, Public Order & Safety",
    93: "Finance, Taxation & Monetary Policy",
    94: "Administration of Human Resources",
    95: "Environmental Quality & Housing",
    96: "Administration of Economic Programs",
    97: "National Security & International Affairs",
    99: "Nonclassifiable Establishments",
}

FINANCIAL_SIC_RANGES = [(6000, 6799)]

# --- fixed values: data-quality thresholds -----------------------------------------------------------------
TOLERANCES = {
    "face_total_rel": 0.001,
    "multi_term_rel": 0.005,
    "abs_floor": 1000,
    "eps_rel": 0.05,
    "restatement_rel": 0.001,
    "outlier_sigma": 5.0,
    "outlier_min_history": 8,
    "magnitude_usd_max": 1.0e14,
    "magnitude_shares_max": 1.0e13,
    "magnitude_eps_max": 1.0e5,
}

NON_NEGATIVE_TAGS = [
    "Assets",
    "AssetsCurrent",
    "Liabilities",
    "LiabilitiesCurrent",
    "LiabilitiesAndStockholdersEquity",
    "InventoryNet",
    "AccountsReceivableNetCurrent",
    "CashAndCashEquivalentsAtCarryingValue",
    "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents",
    "CostOfRevenue",
    "CostOfGoodsAndServicesSold",
    "PaymentsToAcquirePropertyPlantAndEquipment",
    "WeightedAverageNumberOfSharesOutstandingBasic",
    "WeightedAverageNumberOfDilutedSharesOutstanding",
    "CommonStockSharesOutstanding",
    "dei:EntityCommonStockSharesOutstanding",
    "PropertyPlantAndEquipmentNet",
    "Goodwill",
]

ALLOWED_FP = ["FY", "Q1", "Q2", "Q3", "Q4", "H1", "H2", "M9", "T1", "T2", "T3", "CY"]

# --- fixed values: metrics every primary filing has to report ----------------------------------------------
MANDATORY_METRICS = {
    "annual": [
        "total_assets",
        "liabilities_and_equity",
        "equity_parent",
        "net_income",
        "operating_cash_flow",
        "revenue",
    ],
    "quarterly": [
        "total_assets",
        "liabilities_and_equity",
        "equity_parent",
        "net_income",
        "revenue",
    ],
}

FINANCIAL_EXEMPT = ["revenue"]

CONDITIONAL_METRICS = {"revenue": ["cost_of_revenue", "gross_profit"]}

# --- fixed values: ingest window and scope -----------------------------------------------------------------
IN_SCOPE_FORMS = ["10-K", "10-K/A", "10-KT", "10-KT/A", "10-Q", "10-Q/A", "10-QT", "10-QT/A"]
LATEST_QUARTER = "2026q2"
N_QUARTERS = 8
MAX_REJECT_RATE = 0.0001
