"""Fixed values. Results are only right if these equal the published ones."""

# --- fixed values: the registry and its event signatures --------------------------------

REGISTRY_CONTRACT = "0x8004a169fb4a3325136eb29fa0ceb6d2e539a432"
REGISTRY_CHAIN_ID = 8453
REGISTRY_CHAIN = "Base"
REGISTRY_CAIP_ID = "eip155:8453:0x8004a169fb4a3325136eb29fa0ceb6d2e539a432"
ZERO_ADDRESS = "0x0000000000000000000000000000000000000000"

TOPIC_REGISTERED = "0xca52e62c367d81bb2e328eb795f7c7ba24afb478408a26c0e201d155c449bc4a"
TOPIC_URI_UPDATED = "0x3a2c7fffc2cba7582c690e3b82c453ea02a308326a98a3ad7576c606336409fb"
TOPIC_TRANSFER = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
TOPIC_METADATA_SET = "0x2c149ed548c6d2993cd73efe187df6eccabe4538091b33adbd25fafdb8a1468b"
# A cache-refresh notice; it repeats ids the other events already carry and is not ingested.
TOPIC_METADATA_UPDATE = "0xf8e1a15aba9398e019f0b49df1a4fde98ee17ae345cb5f6b5e2c27f5033e8ce7"

EVENT_TOPICS = {
    "Registered": TOPIC_REGISTERED,
    "URIUpdated": TOPIC_URI_UPDATED,
    "Transfer": TOPIC_TRANSFER,
    "MetadataSet": TOPIC_METADATA_SET,
}

# --- fixed values: the block clock ------------------------------------------------------

ANCHOR_BLOCK = 41453265
ANCHOR_EPOCH_SECONDS = 1769695877
SECONDS_PER_BLOCK = 2
CONFIRMATIONS = 50
CHUNK_BLOCKS = 5000
STALL_HOURS = 6.0

# --- fixed values: statistics -----------------------------------------------------------

WILSON_Z = 1.96
SURVIVAL_HORIZONS_DAYS = (30, 90)
SURVIVAL_TOLERANCE_DAYS = 7
PANEL_HASH_SPACE = 4294967296

# --- fixed values: funnel stages and censored categories --------------------------------

STAGES = (
    ("s1_uri_present", "non-empty URI"),
    ("s2_resolved", "URI resolves"),
    ("s3_valid_json", "valid JSON"),
    ("s4_schema_match", "matches ERC-8004 schema"),
    ("s5_has_services", "declares services"),
    ("s6_endpoint_alive", "endpoint responds"),
    ("live_strict", "endpoint responds (strict)"),
)
STUDY_STAGES = (
    ("registered", None),
    ("non-empty URI", "s1_uri_present"),
    ("URI resolves", "s2_resolved"),
    ("valid JSON", "s3_valid_json"),
    ("matches ERC-8004", "s4_schema_match"),
    ("has services", "s5_has_services"),
    ("endpoint responds", "s6_any_endpoint_alive"),
)
CENSORED_CATEGORIES = ("excluded_by_request", "robots_disallowed", "undetermined")
THROTTLED_CATEGORIES = ("http_429_rate_limited", "http_403_forbidden")

# --- fixed values: document keys, in order of precedence --------------------------------

CANONICAL_TYPES = (
    "https://eips.ethereum.org/eips/eip-8004#registration-v1",
    "https://eips.ethereum.org/eips/eip-8004#registration",
    "https://eips.ethereum.org/eips/eip-8004",
    "erc8004:registration",
)
STUDY_CANONICAL_TYPES = CANONICAL_TYPES + (
    "agentcard",
    "https://schema.org/profilepage",
)
TYPE_KEYS = ("type", "@type", "schemaVersion", "kind")
SERVICE_LIST_KEYS = ("services", "service", "endpoints", "skills", "capabilities")
ENDPOINT_URL_KEYS = ("serviceEndpoint", "endpoint", "url", "uri", "href", "address")
ENDPOINT_TYPE_KEYS = ("type", "serviceType", "name", "id", "protocol")
MAX_ENDPOINTS = 5
MAX_DOCUMENT_BYTES = 2_000_000

# --- fixed values: gateways, in the order they are tried --------------------------------

GATEWAYS = (
    "https://ipfs.io/ipfs/",
    "https://dweb.link/ipfs/",
    "https://gateway.pinata.cloud/ipfs/",
)
STUDY_GATEWAYS = (
    "https://ipfs.io/ipfs/",
    "https://cloudflare-ipfs.com/ipfs/",
    "https://dweb.link/ipfs/",
)

# --- fixed values: named HTTP answers ---------------------------------------------------

HTTP_CATEGORIES = {
    401: "http_401_unauthorized",
    403: "http_403_forbidden",
    404: "http_404_not_found",
    410: "http_410_gone",
    429: "http_429_rate_limited",
    451: "http_451_blocked",
    500: "http_500",
    502: "http_502_bad_gateway",
    503: "http_503_unavailable",
    504: "http_504_gateway_timeout",
}

# --- fixed values: hosts whose answer is no evidence of a working agent ------------------

GENERIC_HOSTS = (
    "github.com", "raw.githubusercontent.com", "gist.github.com",
    "githubusercontent.com", "gitlab.com", "bitbucket.org", "sourceforge.net",
    "npmjs.com", "pypi.org",
    "facebook.com", "twitter.com", "x.com", "t.me", "telegram.me",
    "discord.com", "discord.gg", "linkedin.com", "instagram.com",
    "youtube.com", "youtu.be", "reddit.com", "medium.com", "mirror.xyz",
    "warpcast.com", "farcaster.xyz",
    "ipfs.io", "cloudflare-ipfs.com", "dweb.link", "gateway.pinata.cloud",
    "pinata.cloud", "mypinata.cloud", "nftstorage.link", "w3s.link",
    "4everland.io", "ipfs.filebase.io", "arweave.net", "gateway.irys.xyz",
    "eips.ethereum.org", "ethereum.org", "schema.org", "w3.org",
    "base.eth", "docs.google.com", "drive.google.com",
    "notion.so", "notion.site",
    "example.com", "example.org", "localhost",
)

# --- fixed values: hosts where a shared name says nothing about a shared operator -------

HOSTING_ONLY_HOSTS = (
    "amazonaws.com", "storage.googleapis.com", "blob.core.windows.net",
    "digitaloceanspaces.com", "r2.cloudflarestorage.com", "r2.dev",
    "cloudfront.net", "b-cdn.net", "fastly.net", "akamaized.net",
    "azureedge.net", "supabase.co",
    "vercel.app", "netlify.app", "workers.dev", "pages.dev", "github.io",
    "gitlab.io", "onrender.com", "fly.dev", "railway.app", "herokuapp.com",
    "web.app", "firebaseapp.com", "ngrok.io", "ngrok-free.app",
    "replit.dev", "glitch.me", "surge.sh",
)
SHARED_HOSTS = GENERIC_HOSTS + HOSTING_ONLY_HOSTS

# --- fixed values: public suffixes two labels deep, and tenant-per-label storage --------

TWO_LABEL_SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "co.jp", "or.jp", "ne.jp",
    "com.au", "net.au", "org.au", "co.nz", "com.br", "com.cn", "com.mx",
    "co.in", "co.kr", "com.tr", "com.sg", "com.hk", "co.za", "com.ar",
    "github.io", "gitlab.io", "pages.dev", "workers.dev",
    "vercel.app", "netlify.app", "web.app", "firebaseapp.com", "herokuapp.com",
    "onrender.com", "fly.dev", "railway.app", "ngrok.io", "ngrok-free.app",
)
BUCKET_SUFFIXES = (
    "storage.googleapis.com", "blob.core.windows.net", "digitaloceanspaces.com",
    "r2.cloudflarestorage.com", "r2.dev", "supabase.co", "cloudfront.net",
    "b-cdn.net", "fastly.net", "akamaized.net", "azureedge.net",
)

# --- fixed values: texts of the published documents -------------------------------------

CENSORED_NOTE = ("not measured: excluded by request, disallowed by robots.txt, or throttled on "
                 "both passes. Kept out of every denominator rather than counted as dead.")
SURVIVAL_NOTE = ("Survival at {days} days needs {days} days of measurements. There are {span}. "
                 "The horizons below are computed on whatever qualifies so far and will be empty "
                 "or unstable until then.")
UNDETERMINED_DETAIL = "throttled on both passes; not counted for or against the agent"
DATA_LICENSE = "CC BY 4.0"
