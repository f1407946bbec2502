"""The layer plans: raw documents to trials and sites, to histories and features."""
