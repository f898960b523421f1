"""Line-level document-quality analytics on Spark."""
