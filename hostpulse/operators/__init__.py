"""DataFrame -> DataFrame steps. Apart from retrieval they accept static and streaming input alike."""
