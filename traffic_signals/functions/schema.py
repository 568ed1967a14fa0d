"""Enumerations, taxonomies and Spark schemas of the canonical observation."""

from __future__ import annotations

SCHEMA_VERSION = 1

# The enumerations of the observation contract.
SOURCE_PROVIDERS = ["vercel", "cloudflare", "netlify", "nginx_log_forwarder", "wordpress", "node_express", "cloudfront_aws", "fastly", "manual", "other"]
INTEGRATION_KINDS = [
    "vercel_nextjs_middleware", "cloudflare_worker", "netlify_edge", "fastly_compute", "cloudfront_aws_realtime_logs", "nginx_log_forwarder", "wordpress_plugin", "node_express", "manual", "other",
]
CLASSIFIED_PROVIDERS = [
    "openai_search_bot", "openai_gptbot", "openai_chatgpt_user", "anthropic_claudebot", "anthropic_claude_search_bot", "anthropic_claude_user", "anthropic_claude_referral",
    "perplexitybot", "perplexity_user", "perplexity_referral", "google_crawler", "google_agent", "google_notebooklm", "google_gemini_referral", "google_referral",
    "microsoft_copilot_referral", "openai_chatgpt_referral", "meta_ai_referral", "meta_external_agent", "meta_external_fetcher", "xai_grok_referral",
    "mistral_le_chat_referral", "bytedance_bytespider", "ai_browser_referral", "other",
]
AGENT_TYPES = [
    "ai_search_crawler", "ai_training_crawler", "ai_browser_user", "ai_referral_visit", "link_preview", "ai_assistant_referral", "search_crawler", "search_referral", "other",
]
HTTP_METHODS = ["GET", "POST", "PUT", "PATCH", "DELETE", "HEAD", "OPTIONS", "OTHER"]
MATCH_KINDS = ["user_agent", "referer", "query", "host", "path", "manual", "other"]
IP_HASH_ALGORITHMS = ["hmac-sha256", "sha256", "none"]
IP_RETENTIONS = ["not_collected", "discarded_after_hash"]

# The taxonomies of the contract.
PROVIDER_BUCKETS = {
    "openai_chatgpt": ["openai_search_bot", "openai_gptbot", "openai_chatgpt_user", "openai_chatgpt_referral"],
    "anthropic_claude": ["anthropic_claudebot", "anthropic_claude_search_bot", "anthropic_claude_user", "anthropic_claude_referral"],
    "perplexity": ["perplexitybot", "perplexity_user", "perplexity_referral"],
    "google_gemini": ["google_agent", "google_notebooklm", "google_gemini_referral"],
    "microsoft_copilot": ["microsoft_copilot_referral"],
    "meta_ai": ["meta_ai_referral", "meta_external_agent", "meta_external_fetcher"],
    "xai_grok": ["xai_grok_referral"],
    "mistral_le_chat": ["mistral_le_chat_referral"],
}
BUCKET_LABELS = {
    "openai_chatgpt": "OpenAI / ChatGPT", "anthropic_claude": "Anthropic / Claude", "perplexity": "Perplexity", "google_gemini": "Google / Gemini",
    "microsoft_copilot": "Microsoft Copilot", "meta_ai": "Meta AI", "xai_grok": "xAI / Grok", "mistral_le_chat": "Mistral / Le Chat", "other": "Other",
}
SIGNAL_FAMILIES = {
    "ai_bot_visit": ["ai_search_crawler", "ai_training_crawler", "ai_browser_user", "link_preview"],
    "ai_referral_visit": ["ai_referral_visit", "ai_assistant_referral"],
    "search_baseline": ["search_crawler", "search_referral"],
}
FAMILY_LABELS = {"ai_bot_visit": "AI bot or fetcher visit", "ai_referral_visit": "AI assistant referral visit", "search_baseline": "Search baseline", "other": "Other"}
INTEGRATION_ORIGINS = [
    ("vercel_nextjs_middleware", "vercel", "Vercel / Next.js middleware"),
    ("cloudflare_worker", "cloudflare", "Cloudflare Worker"),
    ("netlify_edge", "netlify", "Netlify Edge Function"),
    ("fastly_compute", "fastly", "Fastly Compute"),
    ("cloudfront_aws_realtime_logs", "cloudfront_aws", "CloudFront / AWS real-time logs"),
    ("nginx_log_forwarder", "nginx_log_forwarder", "nginx log forwarder"),
    ("wordpress_plugin", "wordpress", "WordPress plugin"),
    ("node_express", "node_express", "Node / Express middleware"),
    ("manual", "manual", "Manual import"),
    ("other", "other", "Other"),
]

CLASSIFICATION = "struct<provider:string,agent_type:string,confidence:double,matched_rule:string,matched_by:string,docs_url:string>"

#: Collected request records.
REQUEST_SCHEMA = (
    "url string, method string, headers map<string,string>, client_ip string, request_id string, "
    "geo struct<country:string,region:string>, observed_at timestamp"
)

# The default fields of a real-time log record, in order.
CLOUDFRONT_FIELDS = [
    "timestamp", "c-ip", "sc-status", "cs-method", "cs-protocol", "cs-host", "cs-uri-stem", "x-edge-request-id", "cs-user-agent", "cs-referer", "cs-uri-query", "c-country",
]
