"""Fixed values.

These must equal the on-chain / ledger conventions for results to be right.
They are public Ethereum constants or the defaults of the export job.
"""

# --- fixed values -----------------------------------------------------------
# keccak256("Transfer(address,address,uint256)"), topic 0 of every ERC-20 Transfer log
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
# USDC token contract on Ethereum mainnet (lower-case hex)
USDC_CONTRACT = "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48"
NETWORK = "ethereum-mainnet"
TOKEN = "USDC"
WEI_PER_ETH = 1e18
WEI_PER_GWEI = 1e9
UINT64_MAX = 18446744073709551615
# moving-average frame: the current row and the 6 rows before it (rows, not days)
MA_ROWS_PRECEDING = 6
# largest block span of one log request
MAX_BLOCKS_PER_REQUEST = 1000
# blocks per landing folder of raw logs / headers / receipts (sinks.raw_logs)
BUCKET_BLOCKS = 100_000
# --- end of fixed values ----------------------------------------------------

# Decimal types used for exact wei arithmetic: a uint64 needs 20 digits; the
# product of two of them and every sum of products stays exact in 38 digits.
UINT_DECIMAL = "decimal(20,0)"
