"""Output schemas."""

# The business names of the policy extract, in output order.
POLICY_COLUMNS = (
    "Source System Name", "Source System Code", "Writing Company", "Policy Symbol",
    "Policy Number", "Original Policy Number", "Product Code", "Transaction Date",
    "Transaction Effective Date", "Transaction Type", "Transaction Code", "Transaction Desc",
    "Policy Effective Date", "Policy Expiration Date", "Underwriting Year",
    "Accounting Year Month", "Risk State", "Cell", "Segment Code",
    "Financial Line of Business Code", "Changed Premium Amount", "Written Premium Amount",
    "Commission Percentage", "Commission Amount", "Commission Amount (Calculated)",
    "Company Number", "Annual Statement Line of Business", "Coverage Code", "Coverage TP Code",
    "Subline Code", "Claim_Made Indicator", "Reinsurance Code", "Line of Business",
    "Bureau Type", "Distribution Channel", "Group Destination Code", "Service Office",
    "Master Account Number", "Agency Number", "Policy Kind Code", "Program Code",
    "Organization Code", "Sub Program Code", "Business Type Code", "Policy Type Code",
    "Coverage Part Code", "Market Segment Code", "Policy Structure", "Insurer SIC Code",
    "Ownership Type Code", "Treaty Code", "Transaction Expiration Date",
    "Primary Address Zip Code", "Primary Address City", "Primary Address County", "Class Code",
    "Retroactive Date", "Tail Date", "Coinsurance Value", "Policy Event Type Code",
    "Renewal Count", "Cancellation Description", "Exposure Amount", "Exposure Base",
    "Insured SIC Code", "Revision Number", "Insured Property Location Number",
)

# Prefixes of the columns that widening adds.
POLICY_LIMIT = "Policy Limit Amount"
DEDUCTIBLE = "Coverage Deductible Amount"
COVERAGE_LIMIT = "Coverage Limit Amount"
EXPOSURE_AMOUNT = "Line of Business Exposure Amount"
EXPOSURE_BASE = "Line of Business Exposure Base"
MODIFIER = "Coverage Level Schedule Modifier Rate Percent"

# The business names of the claim extract, in output order.
CLAIM_COLUMNS = (
    "Claim Source Name", "Claim Source Code", "UW Source Name", "Accounting Year",
    "Accounting Month", "Writing Company", "Claim Number", "Claim Public Id", "Policy Number",
    "Policy Effective Date", "Transaction Date", "Transaction Type", "Cost Type",
    "Cost Category Code", "Cost Category Type", "Claim Status", "Date of Loss",
    "Accident Year", "Loss State", "Erode Reserve Flag", "Cell", "Segment Code",
    "Financial Line of Business", "Transaction Amount", "Reserve Line Public Id",
    "Batch Date", "Transaction Status", "Retired Flag",
)
