"""The one stream: a folder that receives file drops."""
